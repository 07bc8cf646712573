"""Small tables with every awkward case, and plain-Python versions of what operators count."""

import re
import zlib

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
COPY = "this very text is here a few times so that copies of it can be found again"

DOCS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", "fr", "a"), (4, "one", None, None),
    (5, "a b c d", "en", None), (6, LONG, "en", "b"), (7, COPY, "en", "b"), (7, COPY, "en", "b"),
    (8, COPY, "de", "c"), (None, COPY, "en", "c"), (None, None, None, None), (9, COPY.upper(), "en", "é"),
    (10, "ünï çödé wörds ünï çödé wörds", "de", "a"), (11, "x " * 40 + "\n" + "x " * 40, "en", "a"),
    (12, "### $$$ %%% &&& ***", "en", "b"), (13, "1234 5678 !!", "en", "c"),
    (13, "another text under the same id as before it", "en", "c"),
]

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Columns that clash with names operators use, and types that hash functions refuse.
    T.StructField("size", T.StringType()), T.StructField("shard", T.IntegerType()), T.StructField("node", T.StringType()),
    T.StructField("t", T.StringType()), T.StructField("label", T.StringType()), T.StructField("n", T.StringType()),
    T.StructField("odd `name`.x", T.StringType()), T.StructField("tags", T.MapType(T.StringType(), T.IntegerType())),
])


def awkward(spark):
    rows = [(i, t, lang, src, None if t is None else len(t), "big", 99, "n", "t", "l", None, "o", {"k": 1})
            for i, t, lang, src in DOCS]
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def crc(value):
    return zlib.crc32(str(value).encode())


def shingles(text):
    ws = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4)))
