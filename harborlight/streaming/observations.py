"""Price observations as a stream, kept as the current price of each menu."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from harborlight.session import shared_dir
from harborlight.sources import files
from harborlight.streaming.snapshots import is_folder, run_incremental

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newest_price(rows: DataFrame, keys: list[str], price: str, order: list[str]) -> DataFrame:
    """Price with the highest order values per key, with those values."""
    last = F.max_by(F.struct(F.col(price).alias("price"), *order), F.struct(*order))
    return rows.groupBy(*keys).agg(last.alias("r")).select(*keys, "r.*")


def newest_processor(keys: list[str], values: list[str], state: T.StructType) -> StatefulProcessor:
    """Keeps the rank of the newest observation of a key as value state; a key whose newer one comes gives a row of keys and values.

    Rows are keys, values, and the rank: microseconds of the event time, and what decides between equal times. An event-time timer at that
    observation forgets the state once the watermark has passed it: what may still come is newer.
    The class is made here, so that Spark ships it whole: the process that starts it knows no files of the application.
    """
    row, first, last = Row(*keys, *values), len(keys), len(keys) + len(values)

    class Newest(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.newest = handle.getValueState("newest", state)

        def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803 the interface's names
            best = max((tuple(r) for r in rows), key=lambda r: r[last:])
            old = self.newest.get()
            if old is None or tuple(old) < best[last:]:
                self.newest.update(best[last:])
                self.handle.registerTimer(best[last] // 1000)
                yield row(*key, *best[first:last])

        def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
            old = self.newest.get()
            if old is not None and tuple(old)[0] // 1000 <= expiredTimerInfo.getExpiryTimeInMs():
                self.newest.clear()
            return iter(())

        def close(self) -> None:
            pass

    return Newest()


def current_prices(stream: DataFrame, keys: list[str], price: str, order: list[str], root: str, checkpoint: str, late: str = "7 days", count: int = files.BUCKETS) -> StreamingQuery:
    """Run the stream to its end (STR-2) into table `prices` of root: repeated events change nothing, late rows never replace newer prices.

    order: event time first, then what decides between equal times. Rows without key, time or order value take no part.
    """
    spark = stream.sparkSession
    rows = stream.select(*keys, F.col(price).alias("price"), *order).dropna(subset=[*keys, *order])
    schema = rows.schema
    rank = {"_micros": F.unix_micros(order[0])} | {f"_rank{i}": F.col(c) for i, c in enumerate(order[1:])}
    ranked = rows.select("*", *[c.alias(n) for n, c in rank.items()])
    state = T.StructType(ranked.schema.fields[len(schema.fields) :])
    processor = newest_processor(keys, ["price", *order], state)
    newest = ranked.withWatermark(order[0], late).groupBy(*keys).transformWithState(statefulProcessor=processor, outputStructType=schema, outputMode="Update", timeMode="EventTime")
    merge = lambda old, batch: newest_price(old.unionByName(batch), keys, "price", order)
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)  # the only store that keeps such state; the query takes its own copy of the settings
    try:
        return run_incremental(newest, root, "prices", keys, checkpoint, lambda batch: newest_price(batch, keys, "price", order), merge=merge, mode="update", count=count)
    finally:
        spark.conf.set(_PROVIDER, before)


def stream_current_prices(spark: SparkSession, path: str) -> DataFrame:
    """Current price per user and event type of an events table read as a stream."""
    home = f"{shared_dir(spark)}/harborlight/prices-{uuid.uuid4().hex}"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    folder, name = path.rsplit("/", 1)
    # a stream reads folders; a table that is one file is picked from its folder
    events = reader.parquet(path) if is_folder(spark, path) else reader.option("pathGlobFilter", name).parquet(folder)
    rows = events.select(F.col("user_id").alias("food_place_id"), F.col("event_type").alias("menu_name"), F.round("value").cast("int").alias("observed_price"), F.col("ts").cast("timestamp").alias("observed_at"), "event_id")
    current_prices(rows, ["food_place_id", "menu_name"], "observed_price", ["observed_at", "event_id"], f"{home}/snapshots", f"{home}/checkpoint").awaitTermination()
    return files.current(spark, f"{home}/snapshots", "prices").select("food_place_id", "menu_name", "price")
