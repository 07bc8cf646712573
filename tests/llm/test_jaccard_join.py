import random
from collections import Counter, defaultdict

import pytest

from hypeline.llm import jaccard_join

from .cases import DOCS, SF, awkward, nothing, shingles


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs that share a shingle."""
    sets, parent, holders = [shingles(t) for _, t in rows], list(range(len(rows))), defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for h in s:
            holders[h].append(i)
    for a, b in {(a, b) for v in holders.values() for a in v[:200] for b in v if a < b}:
        inter = len(sets[a] & sets[b])
        if 100 * inter >= 75 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    low = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        low[root(i)].append(doc_id)
    first = {r: min((x for x in v if x is not None), default=None) for r, v in low.items()}
    return Counter((d, len(sets[i]), first[root(i)]) for i, (d, _) in enumerate(rows))


def joined(docs):
    return Counter(map(tuple, jaccard_join.component_ids(docs).collect()))


def test_sf_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert joined(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("frequent,region", [(1, 8), (10**9, 256)])
def test_groups_of_near_copies_around_the_threshold(spark, monkeypatch, frequent, region):
    """Every shingle frequent and regions split recursively, or no shingle frequent: same links."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "REGION", region)
    monkeypatch.setattr(jaccard_join, "COMPARED", region)
    monkeypatch.setattr(jaccard_join, "SAMPLE", 2)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 3)
    rng, rows = random.Random(7), []
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    common = [word() for _ in range(30)]
    for g in range(4):
        base = [word() for _ in range(60)] + (common if g % 2 else [])
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w[rng.randrange(0, 3):])))
    rows += [(1000 + i, " ".join(common + [word() for _ in range(40)])) for i in range(20)]
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_null_and_repeated_ids_fetch_one_text_per_set(spark, monkeypatch):
    """Rows are fetched by their fingerprint: ids that many rows share multiply nothing."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    rows = []
    for i in range(400):
        w = [word() for _ in range(40)]
        for k in range(2):
            w[rng.randrange(40)] = word()
            rows.append((None if i % 2 else 7, " ".join(w)))
    rows += [(7, rows[0][1])] * 300                                    # one row repeated
    sizes = []
    of = jaccard_join.Sets.of
    monkeypatch.setattr(jaccard_join.Sets, "of", lambda self, nodes: (sizes.append((nodes.count(), (out := of(self, nodes)).count())), out)[1])
    assert joined(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)) == brute(rows)
    assert sizes and all(a == b for a, b in sizes)


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert joined(docs) == brute([d[:2] for d in DOCS])
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    left = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert left == Counter([1, 2, 3, 4, 5, 6, 7, None, 10, 11, 12, 13, 13])


def test_empty(spark):
    assert jaccard_join.component_ids(nothing(spark)).count() == 0
    assert jaccard_join.keep_one(nothing(spark)).count() == 0


def test_prefix_is_what_a_partner_cannot_avoid():
    for n in range(1, 400):
        k = jaccard_join.prefix_length(n)
        # Without the first k of n elements too few are left, without k - 1 there are enough.
        assert 100 * (n - k) < 75 * n <= 100 * (n - k + 1)
