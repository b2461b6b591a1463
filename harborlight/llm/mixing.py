"""Mixing sources to target weights, with DataFrame functions only.

Words are counted per source, targets follow from the weights, and each document is repeated floor(rate) times plus
one more copy with probability equal to the fraction. The extra copy is drawn from a hash of seed, id and text, so
reruns agree and no order or window over documents is needed.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a source without words
has target 0 and rate 0; equal rows (same id and text) get the same number of copies; an empty table gives an empty
result. Columns of `docs` with the names of report columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlight.session import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Sources up to this number are joined by broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 50_000


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), ceiling: float = 3.0, text: str = "text", source: str = "source") -> DataFrame:
    """One row per source: source, source_size, target.

    Targets share all words by weight; one stops at `ceiling` times its source's size and the excess goes to the
    others by weight. In order of ceiling over weight, the stopped sources come first, so the level at which the rest
    is shared is the first one that the next source's ceiling reaches. Windows run over sources, not documents.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size_of(F.col(text))).alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name) - 1).withColumn("_weight", weight)
    ranked = ranked.withColumn("_most", F.col("source_size") * F.lit(ceiling)).withColumn("_ratio", F.col("_most") / F.col("_weight"))
    order = Window.orderBy("_ratio", "_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))) / F.sum("_weight").over(rest)
    levelled = ranked.withColumn("_level", level)
    fits = F.min_by(F.when(F.col("_ratio") >= F.col("_level"), F.col("_level")), F.when(F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "_rank")))
    levelled = levelled.withColumn("_shared", F.coalesce(fits.over(everything), F.max("_level").over(everything)))
    return levelled.select("source", "source_size", F.least(F.col("_most"), F.col("_shared") * F.col("_weight")).alias("target"))


def draw(seed: str, *columns: Column) -> Column:
    """A number in [0, 1) from a hash of the seed and the columns."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), ceiling: float = 3.0, seed: str = "mix-1", text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """docs with size, source_size, target and copies (long)."""
    docs = docs.select(*[c for c in docs.columns if c not in ("size", "source_size", "target", "copies")])
    targets = stored(source_targets(docs, weights, ceiling, text, source), "mix-targets")
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    targets = targets.withColumnRenamed("source", "_mix_source")
    joined = docs.withColumn("size", size_of(F.col(text))).join(targets, F.col(source).eqNullSafe(F.col("_mix_source")), "left").drop("_mix_source")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(ceiling))).otherwise(0.0)
    extra = draw(seed, F.col(doc_id), F.md5(F.coalesce(F.col(text), F.lit("")))) < rate - F.floor(rate)
    return joined.withColumn("copies", F.floor(rate) + extra.cast("long"))


def emit_mix(planned: DataFrame) -> DataFrame:
    """The mixed corpus: each document as many times as `copies` says, with its number `copy` from 1."""
    return planned.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
