"""Run log: appended start and end rows, their latest state, and reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "id long, job_name string, run_type string, status string, started_at timestamp, finished_at timestamp, fetched long, upserted long, failed long, metadata string"


def start_row(spark: SparkSession, run_id: int, job: str, at, run_type: str = "manual") -> DataFrame:
    """A running row (MUT-20)."""
    return spark.createDataFrame([(run_id, job, run_type, "running", at, None, None, None, None, None)], SCHEMA)


def end_row(spark: SparkSession, run_id: int, job: str, started, finished, status: str, fetched: int, upserted: int, failed: int, metadata: dict, run_type: str = "manual") -> DataFrame:
    """The final row of a run, with counters and metadata as JSON (MUT-20)."""
    return spark.createDataFrame([(run_id, job, run_type, status, started, finished, fetched, upserted, failed, json.dumps(metadata, ensure_ascii=False, sort_keys=True, default=str))], SCHEMA)


def append(spark: SparkSession, root: str, row: DataFrame) -> None:
    """One row more in the written log."""
    row.coalesce(1).write.mode("append").parquet(f"{root}/_run_log")


def read(spark: SparkSession, root: str) -> DataFrame:
    """The written log: start and end rows of all runs."""
    return spark.read.schema(SCHEMA).parquet(f"{root}/_run_log")


def latest(log: DataFrame) -> DataFrame:
    """One row per run: its final row if there is one."""
    done = F.struct(F.col("finished_at").isNotNull().alias("d"), "finished_at")
    return log.groupBy("id").agg(F.max_by(F.struct(*[c for c in log.columns if c != "id"]), done).alias("r")).select("id", "r.*")


def last_success(log: DataFrame, *columns: str) -> DataFrame:
    """The latest successful run of each job (WIN-6)."""
    good = log.filter("status = 'success'")
    return good.groupBy("job_name").agg(F.max("id").alias("id"), *[F.max_by(c, "id").alias(c) for c in columns])


def recent(log: DataFrame, n: int = 20) -> DataFrame:
    """The last n runs (LIM-4)."""
    return log.orderBy(F.col("started_at").desc(), F.col("id").desc()).limit(n)


def error_sample(rejects: DataFrame, by: str, order: str, n: int = 50, length: int = 300) -> DataFrame:
    """At most n rejects per run, with short messages (LIM-5)."""
    ranked = rejects.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(order))).filter(F.col("_n") <= n)
    return ranked.withColumn("error", F.substring("error", 1, length)).drop("_n")
