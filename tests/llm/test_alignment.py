"""Token alignment against the tokenizers' own libraries and a plain two-pointer loop."""

import hashlib
import random
import re
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from hypeline.llm import alignment
from hypeline.llm.byte_bpe import Table
from tests.llm.cases import SF, awkward, nothing

ALPHABET = " \n\t  '''strevelldm abcAZ09½Ⅷ٣!?.,—é日本 \u0085😀́’"
AWKWARD = ["a" * 5000, " " * 3001, " " * 17 + "b", "<s> <|endoftext|> </s><unk><0x41>", "a▁b", "▁", "x ▁",
           "\x00a\x01", "ﬁ Å Å", "\r\n a\r", "a\t  b", "it's we'll"]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(alignment.byte_level(public_tokenizers.path("byte_bpe_50k.json")),
                             alignment.Pieces.from_file(public_tokenizers.path("piece_bpe_32k.model")))


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.byte = {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}

    def groups(self, text):
        """Groups of ids, or None for a text without tokens."""
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False)
        b = self.b.encode(text)
        ta = [bytes(self.byte[c] for c in t) for t in a.tokens]
        names = [self.b.id_to_piece(i) for i in b]
        tb = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n) else n.replace("▁", " ").encode() for n in names]
        if b"".join(ta) != (" " + text).encode() or b"".join(tb) != (" " + text).encode():
            return None
        ends = lambda ts: list(accumulate(map(len, ts)))
        ea, eb = ends(ta), ends(tb)
        out, ids, i, j = [], a.ids, 0, 0
        for cut in sorted(set(ea) & set(eb)):
            x, y = i, j
            while i < len(ea) and ea[i] <= cut:
                i += 1
            while j < len(eb) and eb[j] <= cut:
                j += 1
            out.append((ids[x:i], b[y:j]))
        return out


def links(groups):
    c = Counter()
    for x, y in groups or []:
        for a, n in Counter(x).items():
            for b, m in Counter(y).items():
                c[a, b] += n * m
    return c


def digest(groups):
    if groups is None:
        return ""
    text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    return hashlib.sha256(text.encode()).hexdigest()


def report(rows):
    """Brute-force rows for [(doc_id, text)]."""
    brute = Brute()
    groups = [(i, brute.groups(t)) for i, t in rows]
    counts = Counter(p for _, g in groups for p in links(g))
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for i, g in groups:
        c = links(g)
        out.append((i, sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), sum(c.values()),
                    sum(m for p, m in c.items() if counts[p] == most[p[0]]), sum(m * counts[p] for p, m in c.items()), digest(g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("lane, large", [(256, 4096), (4, 4096), (16, 3)])
def test_batches(aligner, monkeypatch, lane, large):
    monkeypatch.setattr(alignment, "LANE", lane)
    monkeypatch.setattr(alignment, "LARGE", large)
    rng, brute = random.Random(11), Brute()
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 60))) for _ in range(600)] + AWKWARD
    got = aligner.align(pa.array([None, "", *texts]))
    hashes = alignment._digests(got, aligner.first, Table([b"%d," % i for i in range(32000)]))
    place = {int(r) - 2: k for k, r in enumerate(got["rows"])}
    for i, text in enumerate(texts):
        groups = brute.groups(text)
        assert (groups is None) == (i not in place), text
        if groups is not None:
            k = place[i]
            at = slice(got["pairs_from"][k], got["pairs_from"][k + 1])
            found = dict(zip(zip(got["pair_a"][at].tolist(), got["pair_b"][at].tolist()), got["links"][at].tolist()))
            assert hashes[k] == digest(groups) and Counter(found) == links(groups), text


@pytest.mark.parametrize("hot_pairs", [10 ** 6, 300, 0])
def test_report(spark, aligner, hot_pairs):
    docs = awkward(spark).select("doc_id", "text", "n").unionByName(
        spark.createDataFrame([(100 + i, t, None) for i, t in enumerate(AWKWARD)], "doc_id long, text string, n string"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = alignment.alignment_report(docs, aligner, hot_pairs=hot_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == report(rows)


def test_table(spark, aligner):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted([tuple(r) for r in alignment.alignment_report(docs, aligner).collect()], key=str) == report(rows)


def test_empty_table(spark, aligner):
    assert alignment.alignment_report(nothing(spark), aligner).count() == 0


def test_whole_text_path(aligner):
    """The same tokens when the vocabulary does not allow the cache by word."""
    import numpy as np
    from hypeline.llm.tokens import utf8
    whole = alignment.Pieces(aligner.second.model)
    whole._prepare()
    whole.by_word = False
    texts = [" " + t for t in ("a  b", "x ", " ", "", "tea\n\n time", "   three")]
    raw, off = utf8(pa.array(texts))
    for x, y in zip(whole.encode(raw, off), aligner.second.encode(raw, off)):
        assert np.array_equal(x, y)
