"""Quality score: regularised quadratic discriminant over transformed document statistics.

Each text gives `NAMES` statistics, transformed to be closer to normal (logs and logits) and written once as a small table.
Class means and covariances come from sums over all labelled rows, added up by Spark; covariances are shrunk towards the
pooled one and its diagonal. The score is the logistic function of the difference of log densities (Mahalanobis distances
by cached Cholesky factors) plus the log odds of the classes. `TEMPER` softens the difference, because the statistics are less
independent than the densities take them to be; it was set by hand, moves no score past another, and keeps scores off 0 and 1.

Defined results: null and wordless texts have the statistics of an empty text and get a score like any other; an id with
several different labels counts once in each class; null labels are left out; without labels of both classes every score
is the smoothed share of class 1 among the labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlight.llm import _text
from harborlight.llm._arrow import add_columns
from harborlight.session import ship, stored

NAMES = ("words", "mean_word", "word_spread", "upper", "digit", "stops", "symbols", "lines", "distinct", "repeats", "pair_repeats", "ends_odd", "bars", "line_repeats", "wide")
SHRINK_POOLED, SHRINK_DIAGONAL, FLOOR = 0.1, 0.05, 1e-3
TEMPER = 0.25
CUT = 0.3

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[44, 46]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[33:127] = True
_SYMBOL &= ~_LETTER & ~_DIGIT & ~_STOP
_BAR = np.zeros(256, bool)
_BAR[124] = True
_LINE = np.zeros(256, bool)
_LINE[10] = True
_NOT_LINE = ~_LINE


def _distinct(key: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[new], minlength=texts)


def statistics(chunk: _text.Chunk) -> np.ndarray:
    """Transformed statistics, one row per text."""
    texts = chunk.hi - chunk.lo
    data, off = chunk.data, chunk.offsets
    found = _text.words(chunk, _text.NONSPACE, _text.CODES)
    doc, n = found.doc, np.diff(found.first)
    size = (found.end - found.start).astype(float)
    m = np.maximum(n, 1)
    count = lambda table: _text.per_text(table[data], off) if len(data) else np.zeros(texts, np.int64)
    logit = lambda a, b: np.log((a + 0.5) / (np.maximum(b - a, 0) + 0.5))
    mean = np.bincount(doc, size, texts) / m
    spread = np.sqrt(np.maximum(np.bincount(doc, size * size, texts) / m - mean * mean, 0))
    letters, chars = count(_LETTER), np.diff(off)
    same = np.zeros(len(doc), bool)
    if len(doc) > 1:
        same[1:] = (found.hash[1:] == found.hash[:-1]) & (doc[1:] == doc[:-1])
    pairs, inside = _text.windows(found, 2)
    pair_owner = doc[: len(pairs)][inside]
    odd = _SYMBOL[data[found.end - 1]] if len(doc) else np.zeros(0, bool)
    lines = _text.words(chunk, _NOT_LINE, _text.CODES)
    line_count = np.diff(lines.first)
    wide = np.bincount(doc, size > 20, texts)
    columns = [
        np.log1p(n),
        np.log1p(mean),
        np.log1p(spread),
        logit(count(_UPPER), letters),
        logit(count(_DIGIT), chars),
        logit(count(_STOP), chars),
        logit(count(_SYMBOL), chars),
        np.log((line_count + 0.5) / (n + 1)),
        logit(_distinct(found.hash, doc, texts), n),
        logit(np.bincount(doc, same, texts), n),
        logit(_distinct(pairs[inside], pair_owner, texts), np.bincount(pair_owner, minlength=texts)),
        logit(np.bincount(doc, odd, texts), n),
        logit(count(_BAR), chars),
        logit(_distinct(lines.hash, lines.doc, texts), line_count),
        logit(wide, n),
    ]
    return np.stack(columns, 1).astype(np.float32)


FEATURES = [T.StructField("_features", T.BinaryType())]


def _features(column: pa.Array) -> list[pa.Array]:
    rows: list[bytes] = []
    for chunk in _text.chunks(column):
        rows += [r.tobytes() for r in statistics(chunk)]
    return [pa.array(rows, pa.binary())]


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the packed statistics of each row, written once."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_text"))
    return stored(add_columns(slim, "_text", FEATURES, _features).drop("_text"), "quality-statistics")


@dataclass
class Model:
    """Means and Cholesky factors of both classes; empty where a class has no labels."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.prior)
        density = []
        for mean, factor in zip(self.means, self.factors, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            density.append(-0.5 * (z * z).sum(0) - np.log(np.diag(factor)).sum())
        odds = TEMPER * (density[1] - density[0]) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -35, 35)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(NAMES)
    totals = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float32).reshape(-1, d).astype(float)
        label = np.array(batch.column(1).to_pylist())
        for c, total in totals.items():
            own = x[label == c]
            total += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
    size = 1 + d + d * d
    yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], size), pa.int32()), pa.array(np.tile(np.arange(size), 2), pa.int32()), pa.array(np.concatenate([totals[0], totals[1]]))], ["label", "at", "value"])


def train(stats: DataFrame, labelled: DataFrame) -> Model:
    """stats from document_statistics; labelled: doc_id, label (0 or 1). Only class sums reach the driver."""
    ship(stats.sparkSession)
    clean = labelled.filter("doc_id is not null and label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    joined = stats.join(clean, "doc_id").select("_features", "label")
    d = len(NAMES)
    sums = joined.mapInArrow(_sums, "label int, at int, value double").groupBy("label", "at").agg(F.sum("value").alias("value")).collect()
    totals = np.zeros((2, 1 + d + d * d))
    for r in sums:
        totals[r["label"], r["at"]] = r["value"]
    counts = totals[:, 0]
    prior = (counts[1] + 1) / (counts.sum() + 2)
    if counts.min() < 2:
        return Model([], [], prior)
    means = [t[1 : d + 1] / t[0] for t in totals]
    covs = [t[d + 1 :].reshape(d, d) / t[0] - np.outer(m, m) for t, m in zip(totals, means, strict=True)]
    pooled = (counts[0] * covs[0] + counts[1] * covs[1]) / counts.sum()
    factors = []
    for cov in covs:
        shrunk = (1 - SHRINK_POOLED) * cov + SHRINK_POOLED * pooled
        shrunk = (1 - SHRINK_DIAGONAL) * shrunk + SHRINK_DIAGONAL * np.diag(np.diag(shrunk))
        factors.append(np.linalg.cholesky(shrunk + FLOOR * np.eye(d)))
    return Model(means, factors, prior)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted."""
    ship(stats.sparkSession)
    d = len(NAMES)

    def run(column: pa.Array) -> list[pa.Array]:
        x = np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, d).astype(float)
        s = model.scores(x)
        return [pa.array(s, pa.float64()), pa.array((s >= CUT).astype(np.int32), pa.int32())]

    return add_columns(stats, "_features", [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], run).drop("_features")
