"""Toxicity score: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Words are maximal runs of ASCII letters, digits and bytes above 127, lower-cased; features are words, the stems of longer
words (their first `STEM` bytes), pairs of neighbours and pairs with one word between, each present or not, hashed to
2**`BITS` coordinates. Training takes a bounded sample of labelled rows: at most `TRAIN_ROWS` of them and `TRAIN_BYTES` of
coordinates, of each label those with the smallest hash. One task trains on it; only weights reach the driver. Rows go in
batches of `BATCH`, coordinates of fewer than `LEAST_ROWS` rows are left out, rates are per coordinate, and the L1 term leaves
few weights, which are all that is sent to the tasks. Scoring is a map over whole texts.

`STEM`, `EPOCHS`, `ALPHA` and `L1` were chosen by three-fold cross-validation among training rows alone.

Defined results: null and wordless texts get the score of the intercept; ids labelled twice count as toxic if any label is;
null labels are left out; without labels every score is 0 (nothing is known to be toxic); equal rows get equal scores; columns
of `docs` with the names of the new ones are replaced (`drop_toxic` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlight.llm import _text
from harborlight.llm._arrow import add_columns, spare
from harborlight.llm._sample import smallest
from harborlight.session import ship, stored

BITS = 20
TRAIN_ROWS, TRAIN_BYTES = 12_000, 32 << 20
#: At most this part of the sample is toxic; the rest, and what is left of it, is not.
TOXIC_PART = 1 / 3
STEM, LEAST_ROWS, BATCH, EPOCHS = 5, 3, 16, 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 9.0, 0.1
CUT = 0.3


def features(chunk: _text.Chunk, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and owning text of all features (with repeats)."""
    mask = np.uint64((1 << bits) - 1)
    found = _text.words(chunk, _text.ALNUM, _text.CODES_LOWER)
    h, doc, n = found.hash, found.doc, len(found.hash)
    long, stems = _text.stems(chunk, found, STEM, _text.CODES_LOWER)
    at, owner = [_text.mix(h ^ np.uint64(0x51ED270B)), _text.mix(stems ^ np.uint64(0x2545F491))], [doc, doc[long]]
    for gap, salt in ((1, 0xA3B195354A39B70D), (2, 0x1B03738712FAD5C9)):
        if n > gap:
            same = doc[:-gap] == doc[gap:]
            at.append(_text.mix(h[:-gap] * np.uint64(salt) + h[gap:])[same])
            owner.append(doc[:-gap][same])
    return (np.concatenate(at) & mask).astype(np.int64), np.concatenate(owner)


def _feature_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, place = batch.column(1), batch.column(2)
            for chunk in _text.chunks(batch.column(0)):
                at, owner = features(chunk, bits)
                size = chunk.hi - chunk.lo
                key = np.unique(owner << bits | at)
                edges = np.searchsorted(key, np.arange(size + 1) << bits)
                at = (key & ((1 << bits) - 1)).astype(np.int32)
                data = [at[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([label.slice(chunk.lo, size), place.slice(chunk.lo, size), pa.array(data, pa.binary())], ["label", "place", "features"])

    return run


@dataclass
class Model:
    """Non-zero weights by coordinate, and the intercept."""

    at: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int = BITS

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.at] = self.weight
        return out


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> Model:
    """FTRL-proximal over the coordinates and labels of rows, in batches in the given order."""
    labels = np.asarray(labels, float)
    count = np.bincount(np.concatenate([*rows, np.zeros(0, np.int32)]), minlength=1 << bits)
    place = np.cumsum(count >= LEAST_ROWS, dtype=np.int64) - 1
    coordinates = np.flatnonzero(count >= LEAST_ROWS)
    batches = []
    for a in range(0, len(rows), BATCH):
        part = [place[r[count[r] >= LEAST_ROWS]] for r in rows[a : a + BATCH]]
        used, inverse = np.unique(np.concatenate(part), return_inverse=True)
        batches.append((a, a + len(part), used.astype(np.int32), inverse.astype(np.int32), np.repeat(np.arange(len(part), dtype=np.int8), [len(p) for p in part])))
    z, n = np.zeros(len(coordinates)), np.zeros(len(coordinates))
    share = (labels.sum() + 1) / (len(labels) + 2)
    start = bias = float(np.log(share / (1 - share)))
    bias_z = bias_n = 0.0
    for _ in range(epochs):
        for a, b, used, inverse, row in batches:
            zu, nu = z[used], n[used]
            root = np.sqrt(nu)
            w = np.where(np.abs(zu) > L1, -(zu - np.sign(zu) * L1) / ((BETA + root) / ALPHA + L2), 0.0)
            score = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=w[inverse], minlength=b - a) + bias, -35, 35)))
            error = score - labels[a:b]
            gradient = np.bincount(inverse, weights=error[row], minlength=len(used))
            square = np.bincount(inverse, weights=(error * error)[row], minlength=len(used))
            z[used] = zu + gradient - (np.sqrt(nu + square) - root) / ALPHA * w
            n[used] = nu + square
            new = bias_n + float((error * error).sum())
            bias_z += float(error.sum()) - (np.sqrt(new) - np.sqrt(bias_n)) / 0.1 * (bias - start)
            bias_n = new
            bias = start - bias_z / ((BETA + np.sqrt(bias_n)) / 0.1)
    w = np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)
    at = np.flatnonzero(w)
    return Model(coordinates[at].astype(np.int32), w[at].astype(np.float32), float(bias) if len(rows) else -40.0, bits)


def _fit_table(table: pa.Table) -> pa.Table:
    """The sample's rows in order of their place, and the model they give."""
    order = np.argsort(table.column("place").to_numpy(), kind="stable")
    packed = table.column("features").to_pylist()
    labels = table.column("label").to_numpy()[order]
    model = fit([np.frombuffer(packed[i], np.int32) for i in order], labels)
    row = {"at": model.at.tobytes(), "weight": model.weight.tobytes(), "bias": model.bias, "toxic": int(labels.sum()), "rows": len(labels)}
    return pa.Table.from_pylist([row], pa.schema([("at", pa.binary()), ("weight", pa.binary()), ("bias", pa.float64()), ("toxic", pa.int64()), ("rows", pa.int64())]))


def train(docs: DataFrame, labelled: DataFrame, rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> Model:
    """labelled: doc_id and label (0 or 1). The texts of at most `rows` ids are read for their features; of these rows, the first `rows` and `size` bytes are trained on."""
    ship(docs.sparkSession)
    clean = labelled.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    toxic = int(rows * TOXIC_PART)
    sample = smallest(clean.filter("label = 1"), "doc_id", toxic).unionAll(smallest(clean.filter("label = 0"), "doc_id", rows - toxic))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    found = texts.select("text", "label", F.xxhash64("doc_id", "text").alias("place")).mapInArrow(_feature_rows(BITS), "label int, place long, features binary")
    found = stored(found, "toxicity-features")
    # ids may repeat without bound, so the rows are cut once more, and then by their bytes
    few = [found.filter(F.col("label") == k).orderBy("place", "features").limit(n) for k, n in ((1, toxic), (0, rows - toxic))]
    before = Window.partitionBy("label").orderBy("place", "features")
    kept = few[0].unionAll(few[1]).withColumn("_bytes", F.sum(F.octet_length("features")).over(before))
    kept = kept.filter(F.col("_bytes") <= F.when(F.col("label") == 1, int(size * TOXIC_PART)).otherwise(size - int(size * TOXIC_PART)))
    schema = "at binary, weight binary, bias double, toxic long, rows long"
    fitted = kept.select(F.lit(1).alias("all"), "label", "place", "features").groupBy("all").applyInArrow(_fit_table, schema).first()
    if fitted is None:
        return fit([], np.zeros(0))
    model = Model(np.frombuffer(fitted["at"], np.int32), np.frombuffer(fitted["weight"], np.float32), fitted["bias"])
    # the sample holds more toxic rows than the labels do: the intercept goes back to the odds of all labels
    every = {r["label"]: r["count"] for r in clean.groupBy("label").count().collect()}
    own, others = fitted["toxic"], fitted["rows"] - fitted["toxic"]
    if own and others and every.get(0) and every.get(1):
        model.bias += float(np.log(every[1] / every[0]) - np.log(own / others))
    return model


def score_texts(column: pa.Array, weights: np.ndarray, bias: float, bits: int = BITS) -> list[pa.Array]:
    out = []
    for chunk in _text.chunks(column):
        at, owner = features(chunk, bits)
        hot = np.flatnonzero(weights[at])
        key = np.unique(owner[hot] << bits | at[hot])
        total = np.bincount(key >> bits, weights=weights[key & ((1 << bits) - 1)], minlength=chunk.hi - chunk.lo)
        out.append(1 / (1 + np.exp(-np.clip(total + bias, -35, 35))))
    score = np.concatenate(out) if out else np.zeros(0)
    return [pa.array(score, pa.float64()), pa.array((score >= CUT).astype(np.int32), pa.int32())]


def score(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with the score and the prediction."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    cache: dict[str, np.ndarray] = {}

    def run(column: pa.Array) -> list[pa.Array]:
        if "w" not in cache:
            cache["w"] = held.value.dense()
        return score_texts(column, cache["w"], held.value.bias, held.value.bits)

    return add_columns(docs, text, [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())], run)


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that are not predicted to be toxic, with their own columns."""
    names = spare("score", docs.columns), spare("predicted", docs.columns)
    return score(docs, model, text, names).filter(F.col(names[1]) == 0).select(docs.columns)
