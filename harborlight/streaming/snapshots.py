"""Bucketed snapshots that streams keep current: each micro-batch is merged once, into the buckets that it touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from harborlight.sources import files


def is_folder(spark: SparkSession, where: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()


def run_incremental(stream: DataFrame, root: str, table: str, keys: list[str], checkpoint: str, before: Callable[[DataFrame], DataFrame] | None = None, policy: dict | None = None, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None, mode: str = "append", count: int = files.BUCKETS) -> StreamingQuery:
    """Work off what is new in the stream: before(batch), of unique keys, is merged into the table of root (STR-1).

    The checkpoint remembers which files are done, in place of a paging cursor; the manifest remembers the last merged micro-batch
    of this checkpoint, so that a batch that is repeated after a crash changes nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = before(batch) if before else batch
        files.upsert(batch.sparkSession, root, table, rows, keys, policy, merge, stream=(checkpoint, batch_id), count=count)

    return stream.writeStream.foreachBatch(apply).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
