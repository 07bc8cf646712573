"""Driver queries and the pipeline at sf0.001."""

import subprocess
import sys
from collections import Counter

import pytest

import __spark_entry__ as E
import corpus_pipeline
from hypeline.llm import mixing, toxicity
from hypeline.llm.common import materialise, table
from hypeline.llm.oracles import ORACLES
from hypeline.llm.queries import QUERIES
from hypeline.plans.compare import compare, duck

from .cases import SF, awkward, nothing, words
from .test_jaccard_join import brute
from .test_passages import brute as best_overlap


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    ok, message = compare(E.queries()[name](spark, SF), duck(SF), ORACLES[name])
    assert ok, message


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES if q != "pipeline"}
    assert set(QUERIES) <= set(E.queries())


def test_entry_works_without_the_subpackage():
    code = ("import sys\n"
            "class Hide:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith(('hypeline.llm', 'corpus_pipeline')):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Hide())\n"
            "import __spark_entry__ as E\n"
            "assert len(E.queries()) >= 40 and not any(q.startswith('op1') for q in E.queries())\n"
            "assert 'pipeline' not in E.queries()\n")
    subprocess.run([sys.executable, "-c", code], check=True)


def test_pipeline_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF), name))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "benchmark", "mixing", "sharding"]
    assert all(df.columns == docs.columns for df in out[1:-1])
    rows = [[(r.doc_id, r.text) for r in df.collect()] for df in out]

    toxic = {r.doc_id for r in toxicity.score(docs, toxicity.train(docs, table(spark, SF, "labels"))).where("toxic = 1").collect()}
    assert {i for i, _ in rows[0]} - {i for i, _ in rows[1]} == toxic

    keep = {}
    for (i, _, c), _ in brute(rows[1]).items():
        keep[c] = min(i, keep.get(c, i))
    assert sorted(i for i, _ in rows[2]) == sorted(keep.values())

    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    for i, text in rows[2]:
        if len(words(text)) < 250:
            leaks = any(best_overlap(text, t) >= min(12, -(-3 * len(words(t)) // 4)) for t in items)
            assert ((i, text) in rows[3]) != leaks
    assert set(rows[3]) <= set(rows[2])

    copies = {r.doc_id: r.copies for r in mixing.mix_report(out[3]).collect()}
    assert Counter(i for i, _ in rows[4]) == Counter({i: c for i, c in copies.items() if c})

    last = out[5].collect()
    assert Counter((r.doc_id, r.text) for r in last) == Counter(rows[4])
    by = Counter(r.shard for r in last)
    assert max(by.values()) - min(by.values()) <= 1
    assert all(sorted(r.slot for r in last if r.shard == s) == list(range(n)) for s, n in by.items())


def test_run_chains_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} == set(out.columns)
    assert out.count() > 0


def test_pipeline_stages_on_awkward_and_empty_tables(spark):
    for docs in (awkward(spark), nothing(spark)):
        kept = [docs]
        for name, stage in corpus_pipeline.STAGES:
            kept.append(materialise(stage(spark, kept[-1], SF), name))
        assert all(df.columns == docs.columns for df in kept[1:-1])
        ids = [Counter(r.doc_id for r in df.select("doc_id").collect()) for df in kept]
        wordless = Counter([1, 2, 3, None]) if ids[0] else Counter()
        for i in (1, 2, 3):                                # kept by the filtering stages
            assert wordless <= ids[i] and ids[i] <= ids[i - 1]
        assert set(ids[4]) <= set(ids[3])
        assert sum(ids[5].values()) == sum(ids[4].values())
        # Exact and repeated copies of one text: the smallest id stays.
        if ids[0]:
            assert ids[2][7] == 1 and ids[2][8] == 0
        else:
            assert not any(ids)
