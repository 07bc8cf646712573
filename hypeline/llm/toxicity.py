"""Toxicity by cumulative-link ordinal regression on sparse text features.

One weight vector is shared by all ordered thresholds:
``P(grade > k) = sigmoid(w . x - theta_k)`` with increasing theta.  The output
is the expected severity, the sum of these probabilities, from 0 to the number
of thresholds.

Features are the presence of hashed lower-cased words and of their first four
and five bytes (which join the inflected forms of a stem).  Labels say only
toxic or not, so a toxic training document gets its grade from the number of
different markers of the toxic class in it (grade 1, 2 or 3 by thirds).  Only markers get a weight, which is never
negative and carries an L1 penalty: the words of ordinary prose count nothing,
so severity neither grows with the length of a text nor hides in it.

The fit uses at most about ``FIT_ROWS`` labelled rows, the scoring every word
of every text.

Null and empty cases: a null, empty or very short text without known features
gets the severity of a text without features; rows with a null or
contradictory label are not used to fit; null ids are scored and marked held
out; without any labelled rows of both classes every severity is 0; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypeline.llm import tokens
from hypeline.llm.common import bounded_batches, field, map_rows, materialise
from hypeline.llm.labelled import holdout, sample_labels, sampled_texts
from hypeline.operators.joins import broadcast_if_small

BITS = 18                    # of a filter before the exact look-up of a feature
FIT_ROWS = 8000
FOLDS, FOLD = 5, 0           # ids with crc32 mod 5 = 0 are never fitted on
GRADES = 3                   # severity grades above 0
PREFIXES = (4, 5)
REJECT = 0.15                # rise of the expected severity from which a document is rejected
L1 = 3e-4
MARKER_ODDS = 10
STEPS = 300


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every word and prefix of a batch; features are 64-bit hashes."""
    raw, off = tokens.utf8(column)
    raw = tokens.lower_ascii(raw)
    start, end, first = tokens.word_spans(raw, off)
    rows = np.repeat(np.arange(len(off) - 1, dtype=np.int64), np.diff(first))
    kinds = [tokens.word_hashes(raw, start, end)]
    kinds += [tokens.word_hashes(raw, start, np.minimum(end, start + n)) + np.uint64(n << 8) for n in PREFIXES]
    return np.tile(rows, len(kinds)), np.concatenate(kinds)


def _distinct(rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different (row, feature) pairs, by row."""
    order = np.lexsort((ids, rows))
    rows, ids = rows[order], ids[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1])
    return rows[first], ids[first]


class Model:
    """Weights of the marker features, by their sorted hashes, and the thresholds."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, theta: np.ndarray) -> None:
        self.keys, self.weights, self.theta = keys, weights, theta
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[(keys >> np.uint64(64 - BITS)).astype(np.int64)] = True
        #: Severity of a text without markers: the share of toxic rows that no marker explains.
        self.base = float(_sigmoid(-theta).sum())

    def severity(self, column: pa.Array) -> np.ndarray:
        rows, ids = features(column)
        near = self.seen[(ids >> np.uint64(64 - BITS)).astype(np.int64)]
        rows, ids = _distinct(rows[near], ids[near])
        eta = np.zeros(len(column))
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, ids), len(self.keys) - 1)
            eta = np.bincount(rows, self.weights[at] * (self.keys[at] == ids), minlength=len(column))
        return _sigmoid(eta[:, None] - self.theta).sum(axis=1)

    def toxic(self, severity: np.ndarray, reject: float) -> np.ndarray:
        """Rejected on evidence: by how much markers raise the severity."""
        return severity - self.base >= reject


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def markers(found: DataFrame, toxic: int, clean: int) -> DataFrame:
    """The features that mark the toxic class: their share of toxic rows, lowered by
    two standard errors, is at least ``MARKER_ODDS`` times their share of clean
    rows.  ``found`` has one row per sampled text: toxic and its different
    features; they are counted where they are."""
    n = F.col("toxic_rows")
    sure = F.greatest(n - 2 * F.sqrt(n), F.lit(0.0)) / (toxic + 1)
    return (found.select("toxic", F.explode("ids").alias("feature")).groupBy("feature")
            .agg(F.sum("toxic").alias("toxic_rows"), F.sum(1 - F.col("toxic")).alias("clean_rows"))
            .where(sure > MARKER_ODDS * (F.col("clean_rows") + 0.5) / (clean + 1)).select("feature"))


def grades(toxic: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Severity grades of the training rows: 0 for clean ones, else 1..GRADES by
    the number of different markers found in it."""
    cuts = np.quantile(found[toxic == 1], np.arange(1, GRADES) / GRADES)
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, found, side="right"), 0)


def fit_ordinal(rows: np.ndarray, ids: np.ndarray, y: np.ndarray, size: int, steps: int = STEPS,
                l1: float = L1) -> tuple[np.ndarray, np.ndarray]:
    """(weights of ``size`` features, thresholds): maximum likelihood of the
    cumulative-link model by Adam, with a proximal L1 step on the weights.
    Deterministic: full batches, fixed order."""
    k, n, d = GRADES, len(y), size
    above = np.array([(y > j).mean() for j in range(k)])
    theta = np.log((1 - above + 1e-6) / (above + 1e-6))
    par = np.concatenate([np.zeros(d), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
    m, v = np.zeros_like(par), np.zeros_like(par)
    for t in range(1, steps + 1):
        eta = np.bincount(rows, par[ids], minlength=n)
        theta = np.concatenate([par[d:d + 1], par[d] + np.cumsum(np.exp(par[d + 1:]))])
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        up, lo = _sigmoid(edge[y + 1] - eta), _sigmoid(edge[y] - eta)
        p = np.maximum(up - lo, 1e-9)
        fu, fl = up * (1 - up) / p, lo * (1 - lo) / p
        slope = (fu - fl) / n                                    # d(-log p)/d eta
        g_theta = np.array([(fl[y == j + 1]).sum() - (fu[y == j]).sum() for j in range(k)]) / n
        g = np.concatenate([np.bincount(ids, slope[rows], minlength=d), [g_theta.sum()],
                            np.exp(par[d + 1:]) * np.cumsum(g_theta[::-1])[::-1][1:]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        rate = 0.1 / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-5)
        par = par - rate * m / (1 - 0.9 ** t)
        shrink = np.minimum(rate[:d] * l1, 0.05)
        par[:d] = np.maximum(par[:d] - shrink, 0)      # evidence only adds to severity
    return par[:d], np.concatenate([par[d:d + 1], par[d] + np.cumsum(np.exp(par[d + 1:]))])


def fit(rows: np.ndarray, ids: np.ndarray, toxic: np.ndarray) -> Model:
    """Model from distinct (row, marker) pairs and the rows' labels, of which both occur."""
    keys, ids = np.unique(ids, return_inverse=True)
    y = grades(toxic, np.bincount(rows, minlength=len(toxic)))
    weights, theta = fit_ordinal(rows, ids, y, len(keys))
    return Model(keys, weights, theta)


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, text: str = "text",
          key: str = "doc_id", label: str = "toxic") -> Model:
    """Fit on a bounded sample of labelled rows.  Features are counted in Spark; only the
    sampled rows' labels and the markers found in them reach the driver."""
    bounded_batches(docs.sparkSession)
    rows = sampled_texts(docs, sample_labels(labels, label, fit_rows, FOLDS, FOLD), text, key)

    def extract(batches):
        for batch in batches:
            row, ids = _distinct(*features(batch.column(1)))
            first = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            toxic = np.asarray(batch.column(2)) > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(toxic.astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(first), pa.array(ids.view(np.int64)))], names=["doc_id", "toxic", "ids"])

    found = materialise(rows.mapInArrow(extract, "doc_id long, toxic int, ids array<long>"), "features")
    sampled = found.select("doc_id", "toxic").toArrow().sort_by("doc_id")
    doc, toxic = (np.asarray(sampled[c].combine_chunks()) for c in ("doc_id", "toxic"))
    if len(toxic) == 0 or toxic.min() == toxic.max():
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES, np.inf))
    marks = broadcast_if_small(materialise(markers(found, int(toxic.sum()), int((1 - toxic).sum())), "markers"))
    met = (found.select("doc_id", F.explode("ids").alias("feature")).join(marks, "feature")
           .toArrow().sort_by([("doc_id", "ascending"), ("feature", "ascending")]))
    owner, ids = (np.asarray(met[c].combine_chunks()) for c in ("doc_id", "feature"))
    return fit(np.searchsorted(doc, owner), ids.view(np.uint64), toxic)


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, severity (0 to GRADES) and toxic (1: markers raise it by ``REJECT``) of every row."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            severity = shared.value.severity(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(severity), pa.array(shared.value.toxic(severity, REJECT).astype(np.int32))],
                names=["doc_id", "held_out", "severity", "toxic"])

    return (docs.select(field(key).cast("long").alias("doc_id"), holdout(field(key), FOLDS, FOLD).alias("held_out"),
                        field(text).alias("t"))
            .mapInArrow(run, "doc_id long, held_out boolean, severity double, toxic int"))


def keep_civil(docs: DataFrame, model: Model, text: str = "text", reject: float = REJECT) -> DataFrame:
    """The documents whose severity markers raise by less than ``reject``, with all their columns."""
    bounded_batches(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches):
        for batch in batches:
            severity = shared.value.severity(batch.column(at))
            yield batch.filter(pa.array(~shared.value.toxic(severity, reject)))

    return map_rows(docs, run)


__all__ = ["Model", "features", "markers", "grades", "fit_ordinal", "fit", "train", "score", "keep_civil", "REJECT", "GRADES"]
