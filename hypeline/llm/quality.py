"""Quality classifier: regularised quadratic discriminant analysis.

Each class is a Gaussian over transformed document statistics.  Its covariance
is shrunk towards the pooled covariance and towards a scaled identity, its
Cholesky factor is kept in the model, and a document's score is the posterior
of class 1 from the difference of the two log densities (Mahalanobis distance
through the factor plus log determinant) and the class shares.

The fit uses the statistics of at most about ``FIT_ROWS`` labelled rows; the
scoring reads every whole text.

Null and empty cases: a null text is scored like an empty one (all counts 0);
null or contradictory labels are not used; null ids are scored and count as
held out; without labelled rows of both classes every score is 1; an empty
table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypeline.llm import tokens
from hypeline.llm.common import bounded_batches, field
from hypeline.llm.labelled import holdout, sample_labels, sampled_texts

FIT_ROWS = 20000
FOLDS, FOLD = 5, 0           # ids with crc32 mod 5 = 0 are held out
THRESHOLD = 0.3
TO_POOLED = 0.1              # weight of the pooled covariance
TO_SPHERE = 0.05             # weight of the identity, scaled to the mean variance
WINDOW = 8

NAMES = ("log_words", "word_bytes", "symbols", "upper", "digits", "punctuation", "distinct", "repeated",
         "dup_lines", "line_words")


def _class_table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL = _class_table("#*$%&|<>")
_PUNCT = _class_table("!?;:\"'()[]{}/\\@^_=+~`")
_DIGIT = _class_table("0123456789")


def statistics(column: pa.Array) -> np.ndarray:
    """Transformed statistics of each row, one line of ``NAMES`` per text."""
    raw, off = tokens.utf8(column)
    rows = len(off) - 1
    start, end, first = tokens.word_spans(raw, off)
    hashes = tokens.word_hashes(tokens.lower_ascii(raw), start, end)
    n = np.diff(first)

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[off[1:]] - total[off[:-1]]

    letters = np.concatenate([[0], np.cumsum(end - start)])
    size = np.maximum(letters[first[1:]] - letters[first[:-1]], 1)
    words = np.maximum(n, 1)
    upper = per_row((raw >= 65) & (raw <= 90))
    distinct, repeated, dup, lines = (np.zeros(rows) for _ in range(4))
    breaks = np.flatnonzero(raw == 10)
    at = np.searchsorted(breaks, off)
    for i in range(rows):
        w = hashes[first[i]:first[i + 1]]
        if not len(w):
            continue
        distinct[i] = len(np.unique(w)) / np.sqrt(len(w))
        if len(w) > WINDOW:
            s = tokens.shingle_hashes(w, 5)
            repeated[i] = 1 - len(np.unique(s)) / len(s)
        # A line's hash is the sum of its words' hashes, each multiplied by its place.
        cut = np.searchsorted(start[first[i]:first[i + 1]], breaks[at[i]:at[i + 1]])
        cut = np.unique(np.concatenate([[0], cut[cut < len(w)]])).astype(np.int64)
        place = np.arange(len(w)) - np.repeat(cut, np.diff(np.append(cut, len(w))))
        line = np.add.reduceat(tokens.mix64(w + place.astype(np.uint64)), cut)
        lines[i] = len(cut)
        dup[i] = len(cut) - len(np.unique(line))
    return np.column_stack([
        np.log1p(n), np.log(size / words + 1), np.log1p(per_row(_SYMBOL[raw]) / words),
        np.sqrt(upper / size), np.sqrt(per_row(_DIGIT[raw]) / size), np.log1p(per_row(_PUNCT[raw]) / words),
        np.log1p(distinct), np.sqrt(repeated), np.sqrt(dup / np.maximum(lines, 1)), np.log1p(n / np.maximum(lines, 1))])


@dataclass
class Model:
    means: np.ndarray        # (2, features)
    factors: np.ndarray      # (2, features, features): inverse Cholesky factors
    offsets: np.ndarray      # (2,): log class share minus half the log determinant

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior probability of class 1."""
        log = [self.offsets[c] - 0.5 * (((x - self.means[c]) @ self.factors[c].T) ** 2).sum(axis=1) for c in (0, 1)]
        return 0.5 * (1 + np.tanh(0.5 * (log[1] - log[0])))


def fit_qda(x: np.ndarray, y: np.ndarray, to_pooled: float = TO_POOLED, to_sphere: float = TO_SPHERE) -> Model | None:
    """None unless both classes have rows."""
    if len(y) == 0 or y.min() == y.max():
        return None
    means = np.array([x[y == c].mean(axis=0) for c in (0, 1)])
    own = [(x[y == c] - means[c]).T @ (x[y == c] - means[c]) for c in (0, 1)]
    pooled = (own[0] + own[1]) / len(y)
    factors, offsets = [], []
    for c in (0, 1):
        n = (y == c).sum()
        cov = (1 - to_pooled) * own[c] / n + to_pooled * pooled
        cov = (1 - to_sphere) * cov + to_sphere * max(np.trace(cov) / len(cov), 1e-6) * np.eye(len(cov))
        chol = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(chol))
        offsets.append(np.log(n / len(y)) - np.log(np.diag(chol)).sum())
    return Model(means, np.array(factors), np.array(offsets))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, text: str = "text",
          key: str = "doc_id", label: str = "quality") -> Model | None:
    """Fit on a bounded sample; only its statistics (ten numbers a row) reach the driver."""
    bounded_batches(docs.sparkSession)
    rows = sampled_texts(docs, sample_labels(labels, label, fit_rows, FOLDS, FOLD), text, key)

    def extract(batches):
        for batch in batches:
            x = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *map(pa.array, x.T)],
                                             names=["doc_id", "label", *NAMES])

    schema = "doc_id long, label int, " + ", ".join(f"{n} double" for n in NAMES)
    got = rows.mapInArrow(extract, schema).toArrow()
    table = np.column_stack([got[c].to_numpy().astype(float) for c in got.column_names])
    table = table[np.lexsort(table.T[::-1])]
    return fit_qda(table[:, 2:], (table[:, 1] > 0).astype(int))


def score(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score and predicted (1: score from ``THRESHOLD`` on) of every row."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            x = statistics(batch.column(2))
            value = shared.value.score(x) if shared.value is not None else np.ones(len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select(field(key).cast("long").alias("doc_id"), holdout(field(key), FOLDS, FOLD).alias("held_out"),
                        field(text).alias("t"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))


__all__ = ["Model", "NAMES", "statistics", "fit_qda", "train", "score"]
