"""Language identification: multinomial naive Bayes over hashed character n-grams.

N-grams of one to three characters of the lower-cased text are hashed into
``2^BITS`` buckets.  Counts per language are summed in Spark over a bounded
sample of documents with a known language; the matrix of smoothed
log-probabilities is broadcast, and every whole text is scored by gathering
and adding the matrix rows of its n-grams.

Definitions and edge cases: a text that is null or holds no letter is ``und``
with score 0; the score is the posterior probability of the predicted language
under equal priors; ties go to the first language by code point; documents
without a language are not learned from; without any learned language every
text is ``und``; null ids are scored and count as held out; an empty table
gives no rows.  The number of languages is limited by ``MAX_LANGUAGES``, which
bounds the broadcast matrix; more raise an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypeline.llm.common import bounded_batches, field
from hypeline.llm.labelled import holdout, unit

BITS = 15
ORDERS = (1, 2, 3)
FIT_PER_LANGUAGE = 3000      # documents learned from, per language, about
FOLDS, FOLD = 4, 2           # ids with crc32 mod 4 = 2 are held out
SMOOTHING = 0.5
MAX_LANGUAGES = 500
UNKNOWN = "und"

_MUL = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], dtype=np.uint32)


def buckets(text: str) -> np.ndarray:
    """Buckets of all n-grams of the lower-cased text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    out = []
    for n in ORDERS:
        m = len(points) - n + 1
        if m <= 0:
            break
        h = np.full(m, n * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            h = (h ^ points[k:k + m]) * _MUL[k]
            h ^= h >> np.uint32(15)
        out.append(h * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray         # (buckets, languages), float32

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not has_letter(text):
            return UNKNOWN, 0.0
        total = self.logp[buckets(text)].sum(axis=0, dtype=np.float64)
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          per_language: int = FIT_PER_LANGUAGE) -> Model:
    """Learn from about ``per_language`` documents of each language outside the held-out fold."""
    spark = docs.sparkSession
    bounded_batches(spark)
    narrow = docs.select(field(key).alias("k"), field(text).alias("t"), field(lang).cast("string").alias("l"))
    usable = narrow.where(F.col("l").isNotNull() & F.col("t").isNotNull() & ~holdout(F.col("k"), FOLDS, FOLD))
    sizes = usable.groupBy("l").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return Model([], np.zeros((1 << BITS, 0), np.float32))
    languages = sorted(r["l"] for r in sizes)
    share = F.create_map(*[F.lit(v) for r in sizes for v in (r["l"], min(1.0, per_language / r["count"]))])
    sample = usable.where(unit(F.col("k")) < F.element_at(share, F.col("l"))).select("t", "l").repartition(16)

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, lang_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if has_letter(t):
                    row = totals.setdefault(lang_, np.zeros(1 << BITS, np.int64))
                    row += np.bincount(buckets(t), minlength=1 << BITS)
        for lang_, row in totals.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang_] * len(at)), pa.array(at, pa.int32()), pa.array(row[at])], names=["l", "b", "n"])

    got = (sample.mapInArrow(count, "l string, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros((1 << BITS, len(languages)))
    column = {x: i for i, x in enumerate(languages)}
    counts[got["b"].to_numpy(), [column[x] for x in got["l"].to_pylist()]] = got["n"].to_numpy()
    counts += SMOOTHING
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def identify(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select(field(key).cast("long").alias("doc_id"), holdout(field(key), FOLDS, FOLD).alias("held_out"),
                        field(text).alias("t"))
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))


__all__ = ["Model", "buckets", "train", "identify", "UNKNOWN"]
