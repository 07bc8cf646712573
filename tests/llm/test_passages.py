"""Decontamination and substring deduplication."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from hypeline.llm import chunks, decontamination, tokens

from .cases import DOCS, SF, awkward, nothing, words


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def lower(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in words(text)]


def brute(doc, item):
    """Best verified overlap over every alignment, without seeds."""
    d, t, best = lower(doc), lower(item), 0
    for diagonal in range(-len(t) + 1, len(d)):
        lo, hi = max(0, -diagonal), min(len(t), len(d) - diagonal)
        equal = np.array([t[q] == d[q + diagonal] for q in range(lo, hi)], bool)
        if equal.any():
            best = max(best, decontamination.best_stretch(equal)[2])
    return best


def test_best_stretch_against_all_stretches():
    rng = random.Random(2)
    for _ in range(200):
        equal = np.array([rng.random() < 0.7 for _ in range(rng.randrange(1, 15))])
        score = lambda a, b: sum(1 if e else -3 for e in equal[a:b])
        top = max([0, *(score(a, b) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1))])
        a, b, n = decontamination.best_stretch(equal)
        assert score(a, b) == top and n == equal[a:b].sum()


def test_overlaps_against_brute_force(spark):
    docs, bench = read(spark, "documents"), read(spark, "benchmark")
    got = {(r.doc_id, r.item_id): r.n_matched for r in decontamination.find_overlaps(docs, bench).collect()}
    items = bench.collect()
    for d in docs.where("n_chars < 1500").collect()[:80]:
        for t in items:
            n, need = brute(d.text, t.text), decontamination._needed(len(words(t.text)))
            assert ((d.doc_id, t.item_id) in got) == (n >= need and len(words(t.text)) > 0)
            if n >= need:
                assert got[(d.doc_id, t.item_id)] == n


def test_substituted_words_and_short_items(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau upsilon"
    changed = item.split()
    for i in (5, 11, 17):
        changed[i] = "other"
    docs = spark.createDataFrame([(1, "x " * 30 + " ".join(changed).upper() + " y"), (2, "alpha beta gamma only"), (3, item[:40]),
                                  (4, "it says short item here"), (5, None), (6, "")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "short item"), (3, None), (4, "")], "item_id long, text string")
    for block in (1 << 20, 40):            # one block, and several
        got = sorted((r.doc_id, r.item_id, r.n_matched) for r in decontamination.find_overlaps(docs, bench, block_bytes=block).collect())
        assert got == [(1, 1, 15), (4, 2, 2)]
        assert sorted(r.doc_id for r in decontamination.decontaminate(docs, bench, block_bytes=block).collect()) == [2, 3, 5, 6]


def test_decontamination_awkward_rows(spark):
    bench = spark.createDataFrame([(1, DOCS[6][1])], "item_id long, text string")
    found = decontamination.find_overlaps(awkward(spark), bench).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == [(False, 7), (False, 7), (False, 8), (False, 9), (True, 0)]
    kept = decontamination.decontaminate(awkward(spark), bench)
    assert kept.columns == awkward(spark).columns and kept.count() == len(DOCS) - 5
    assert decontamination.find_overlaps(nothing(spark), bench).count() == 0
    assert decontamination.decontaminate(awkward(spark), bench.limit(0)).count() == len(DOCS)


# -- chunks -----------------------------------------------------------------------
def test_gear_hash_against_the_recurrence():
    raw = np.frombuffer(random.Random(3).randbytes(500), np.uint8)
    h, want = 0, []
    for b in raw:
        h = (2 * h + int(chunks._GEAR[b])) % (1 << 32)
        want.append(h)
    assert chunks.gear_hashes(raw).tolist() == want


def test_cuts_survive_insertions():
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(2000)).encode()
    pieces = lambda b: {b[x:y] for x, y in zip(c[:-1], c[1:])} if len(c := chunks.cuts(np.frombuffer(b, np.uint8)).tolist()) else set()
    a, b = pieces(text), pieces(text[:5000] + b"INSERTED" + text[5000:])
    assert len(a & b) >= len(a) - 8
    border = chunks.cuts(np.frombuffer(text, np.uint8))
    assert border[0] == 0 and border[-1] == len(text) and np.diff(border).max() <= chunks.MAX_CHUNK


def test_repeated_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = []
    for g in range(30):
        passage = prose(55)
        rows += [(3 * g, f"{prose(90)} {passage} {prose(40)}"), (3 * g + 1, f"{passage} {prose(80)}"), (3 * g + 2, prose(150))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = chunks.repeated_spans(docs).collect()
    assert {r.doc_id for r in got} == {3 * g + 1 for g in range(30)}
    assert all(r.first_doc_id == r.doc_id - 1 and r.first_doc_ids == [r.doc_id - 1] for r in got)
    text = dict(rows)
    for r in got:
        span = text[r.doc_id].encode()[r.start_byte:r.start_byte + r.n_bytes]
        assert span in text[r.first_doc_id].encode()
    cut = {r.doc_id: r.text for r in chunks.remove_repeats(docs).collect()}
    lost = {r.doc_id: r.n_bytes for r in got}
    assert all(len(cut[i].encode()) == len(text[i].encode()) - lost.get(i, 0) for i in text)


def test_spans_against_a_loop(spark):
    docs = read(spark, "documents")
    seen, want = {}, set()
    for d in sorted(docs.collect(), key=lambda d: d.doc_id):
        raw = (d.text or "").encode()
        b = chunks.cuts(np.frombuffer(raw, np.uint8)).tolist()
        spans = []
        for x, y in zip(b[:-1], b[1:]):
            if raw[x:y] in seen:
                if spans and spans[-1][1] == x:
                    spans[-1][1] = y
                else:
                    spans.append([x, y])
            else:
                seen[raw[x:y]] = d.doc_id
        want |= {(d.doc_id, x, y - x) for x, y in spans if y - x >= chunks.MIN_SPAN}
    assert {(r.doc_id, r.start_byte, r.n_bytes) for r in chunks.repeated_spans(docs).collect()} == want


def test_spans_against_word_windows(spark):
    """Without the chunker: who holds a passage of 51 words of an earlier text, and who shares no 15 words with one."""
    docs = sorted(read(spark, "documents").collect(), key=lambda d: d.doc_id)
    texts = {d.doc_id: d.text or "" for d in docs}

    def holders(size):
        seen, out = set(), set()
        for i, text in texts.items():
            # Windows of raw bytes, so that white space counts as it does in a substring.
            at = [m.span() for m in re.finditer(r"\S+", text)]
            own = [text[at[k][0]:at[k + size - 1][1]] for k in range(len(at) - size + 1)]
            if any(w in seen for w in own) or len(set(own)) < len(own):
                out.add(i)
            seen.update(own)
        return out

    spans = chunks.repeated_spans(read(spark, "documents")).collect()
    found, passages, shared = {r.doc_id for r in spans}, holders(51), holders(15)
    clean = set(texts) - shared
    assert len(passages) >= 20 and len(clean) >= 50
    assert len(found & passages) >= 0.95 * len(passages)
    assert len(found & clean) <= 0.05 * len(clean)
    # Every byte of a span lies in 24 bytes that an earlier text, or an earlier place, holds.
    order = list(texts)
    for r in spans:
        raw = texts[r.doc_id].encode()
        before = b"\xff".join(texts[i].encode() for i in order[:order.index(r.doc_id)])
        stop, at = r.start_byte + r.n_bytes, r.start_byte
        while at < stop:
            a = min(at, stop - 24)
            piece = raw[a:a + 24]
            assert piece in before or raw.find(piece) < a or any(
                raw[b:b + 24] in before or raw.find(raw[b:b + 24]) < b for b in range(max(r.start_byte, a - 23), a + 1)), (r, a)
            at += 24


def test_chunks_awkward_rows(spark):
    docs = awkward(spark)
    first = chunks.repeated_spans(docs, min_span=1).collect()
    assert {r.doc_id for r in first} >= {8, None} and 7 not in {r.doc_id for r in first}
    out = chunks.remove_repeats(docs, min_span=1)
    assert out.columns == docs.columns and out.count() == len(DOCS)
    assert chunks.repeated_spans(nothing(spark)).count() == 0
    assert chunks.cut_out("aébc", [(2, 2)]) == "aéc"


def test_rows_with_null_or_repeated_ids_are_documents_of_their_own(spark):
    rng = random.Random(6)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    p, q, own = prose(60), prose(60), [prose(80) for _ in range(5)]
    rows = [(None, f"{p} {own[0]}"), (None, f"{p} {own[1]}"),       # one passage, same place, no ids
            (4, f"{q} {own[2]}"), (5, f"{q} {own[3]}"), (5, own[4])]  # two texts under one id
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = chunks.repeated_spans(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in spans) == [(False, 5), (True, None)]
    assert all(r.start_byte == 0 and r.n_bytes <= len(p) + 1 + chunks.MAX_CHUNK for r in spans)
    cut = [r.text for r in chunks.remove_repeats(docs).collect()]
    assert len(cut) == len(rows) and own[4] in cut
    for text in own[:4]:
        assert sum(text in t for t in cut) + sum(text[chunks.MAX_CHUNK:] in t and text not in t for t in cut) == 1
    assert sum(p in t for t in cut) == 1 and sum(q in t for t in cut) == 1


def test_utf8_views_of_sliced_arrays():
    arr = pa.array(["skip", None, "a b", "", "é  c"]).slice(1)
    raw, off = tokens.utf8(arr)
    assert [bytes(raw[a:b]).decode() for a, b in zip(off, off[1:])] == ["", "a b", "", "é  c"]
    assert [len(w) for w in tokens.row_words(arr)] == [0, 2, 0, 2]


@pytest.mark.parametrize("text", ["", " ", "a", "a b\tc\nd\x0be\x0cf\rg", "\x1ca\x1cb", "x" * 2_000_000 + " y"])
def test_words_against_the_pattern(text):
    hashes = next(iter(tokens.row_words(pa.array([text]))))
    assert len(hashes) == len(words(text))
    assert len(set(hashes.tolist())) == len(set(words(text)))
