"""Byte-level BPE against the tiktoken library, on random, adversarial and table texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from hypeline.llm import byte_bpe
from hypeline.llm.tokens import utf8
from tests.llm.cases import SF, awkward, nothing

ALPHABET = " \n\t  '''strevelldm abcAZ09½Ⅷ٣!?.,—é日本 \u0085😀́’"


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec.from_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.tokens, special_tokens={})


def encoded(codec, texts):
    raw, off = utf8(pa.array(texts, pa.string()))
    ids, ends, first = codec.encode(raw, off)
    assert bytes(codec.decode(ids)) == raw.tobytes() and (len(ends) == 0 or ends[-1] == len(raw))
    return [ids[a:b].tolist() for a, b in zip(first, first[1:])]


def test_random_texts(codec, library):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    assert encoded(codec, texts) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("text", ["", " ", "a" * 5000, " " * 3000, "ab" * 4000 + "!" * 999, "\n" * 700 + "x", "'s" * 9,
                                  "it's we'll they'Re 'tis 're''ll don't", "<|endoftext|>", "x'", "x'v", "'", " 's",
                                  "\x00\x7f  　y"])
def test_awkward_texts(codec, library, text):
    # Between other texts, whose ends must not join.
    assert encoded(codec, ["x ", text, "'s", " y"]) == [library.encode_ordinary(t) for t in ("x ", text, "'s", " y")]


def test_classes_of_all_code_points(codec, library):
    """Every code point next to a letter, a digit and an exclamation mark."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    texts = [f"a{chr(c)}b 1{chr(c)}2 !{chr(c)}?" for c in points]
    for i in range(0, len(texts), 40_000):
        part = texts[i:i + 40_000]
        assert encoded(codec, part) == library.encode_ordinary_batch(part, num_threads=4)


def test_cache_generations(codec, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 3)
    fresh = byte_bpe.Codec(codec.tokens)
    rng = random.Random(7)
    for _ in range(30):
        texts = [" ".join(rng.choice(["tea", "coffee", "water", "milk", "juice", "x" * 300]) for _ in range(5)) for _ in range(3)]
        assert encoded(fresh, texts) == [library.encode_ordinary(t) for t in texts]


def test_merge_in_step_equals_heap(codec):
    codec._prepare()
    rng = random.Random(3)
    pieces = [bytes(rng.choice(b"abcdeth in") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    ids, first = codec.merge(pieces)
    for i, p in enumerate(pieces):
        one = [codec.tokens[p]] if p in codec.tokens else codec._merge_long(p).tolist()
        assert ids[first[i]:first[i + 1]].tolist() == one


def test_unknown_id_raises(codec):
    with pytest.raises(IndexError):
        codec.decode(np.array([10 ** 5]))


def test_tables(spark, codec, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (docs, awkward(spark)):
        want = sorted((r["doc_id"] is None, r["doc_id"] or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256((r["text"] or "").encode()).hexdigest())
                      for r in df.select("doc_id", "text").collect() for ids in [library.encode_ordinary(r["text"] or "")])
        got = sorted((r[0] is None, r[0] or 0, *r[1:]) for r in byte_bpe.round_trip(df, codec).collect())
        assert got == want
    assert byte_bpe.round_trip(nothing(spark), codec).count() == 0


def test_encode_and_decode_frames(spark, codec, library):
    docs = awkward(spark)
    rows = byte_bpe.encode(docs, codec)
    texts = sorted((r["doc_id"] or -1, r["text"] or "") for r in docs.select("doc_id", "text").collect())
    got = rows.collect()
    assert sorted((r["doc_id"] or -1, bytes(codec.decode(np.array(r["ids"], np.int64))).decode()) for r in got) == texts
    assert all(r["ends"] == np.cumsum([len(codec.decode(np.array([i]))) for i in r["ids"]]).tolist() for r in got)
    back = byte_bpe.decode(rows, codec).collect()
    assert sorted((r["doc_id"] or -1, r["decoded"].decode()) for r in back) == texts
    null = rows.select("doc_id", F.lit(None).cast("array<int>").alias("ids"))
    assert {bytes(r["decoded"]) for r in byte_bpe.decode(null, codec).collect()} == {b""}
