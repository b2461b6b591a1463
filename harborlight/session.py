"""Session helpers: shipping the package to executors, shared folders, lineage cuts."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor (once per application).

    Where the session keeps Spark's 10,000 rows per Arrow batch, 2,000 are set: rows hold whole texts.
    """
    context = spark.sparkContext
    if spark.conf.get(ARROW_ROWS, "10000") == "10000":
        spark.conf.set(ARROW_ROWS, "2000")
    if getattr(context, "_harborlight_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="harborlight-"), "harborlight.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("harborlight", os.path.relpath(full, root)))
    context.addPyFile(target)
    context._harborlight_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset a local session takes a folder of its own; a cluster must name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="harborlight-shared-"))
    return context.getCheckpointDir().rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/harborlight/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str, figures: dict[str, Column], keep: Column | None = None) -> tuple[DataFrame, dict[str, int]]:
    """stored(df), and figures (aggregates) over the rows of df, taken in the pass that writes it; with `keep`, only such rows are written."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    observed = df.observe(seen, *[c.alias(n) for n, c in figures.items()])
    kept = stored(observed if keep is None else observed.filter(keep), name)
    return kept, dict(seen.get)


def clear(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application. Results that were not yet written or collected can't be read after it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished jobs that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
