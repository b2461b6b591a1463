"""Versioned snapshots of tables: whole or in key-hash buckets, published by compare-and-swap (SNK-1).

A version is one manifest file, root/_manifest/<number>.json, that names for each table the folders of its data. Data folders are written once
and never changed; a version becomes visible with its manifest, which is created only if no other publisher has made that number
(a hard link on local file systems, a rename that does not replace on others). A publisher names the version it was built on. If others came first it
rebases where they changed other tables or other buckets, else it fails with Conflict, and an upsert is made anew. A crash before the manifest leaves
folders that nobody reads; collect() deletes them, and what only old versions name.

A bucketed table keeps the rows of one hash of the keys in one folder. An upsert reads and writes the buckets that its batch touches; the
target is joined where it lies with the batch while Spark takes the batch for small enough to broadcast, else by a shuffle of the touched buckets.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlight.operators.mutations import apply_upsert
from harborlight.session import stored

BUCKETS = 64
_BUCKET = "_bucket"
Manifest = dict


class Conflict(RuntimeError):
    """Another publisher changed the same tables or buckets first."""


def _fs(spark: SparkSession, where: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _put_if_absent(spark: SparkSession, where: str, text: str) -> bool:
    """Create a file with its whole text; false if it is there already."""
    jvm = spark.sparkContext._jvm
    draft, fs = _fs(spark, f"{where}.{uuid.uuid4().hex}.tmp")
    path = jvm.org.apache.hadoop.fs.Path(where)
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() != "file":
            return not fs.exists(path) and fs.rename(draft, path)
        local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
        try:
            jvm.java.nio.file.Files.createLink(local(path), local(draft))
            return True
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                return False
            raise
    finally:
        fs.delete(draft, False)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions in order."""
    path, fs = _fs(spark, f"{root}/_manifest")
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The manifest of a version, the newest if None; before the first one an empty one of number 0."""
    if version is None:
        version = max(versions(spark, root), default=0)
    if version == 0:
        return {"version": 0, "tables": {}, "streams": {}}
    path, fs = _fs(spark, f"{root}/_manifest/{version:012}.json")
    stream = fs.open(path)
    try:
        return json.loads(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def _publish(spark: SparkSession, root: str, base: int, changed: dict[str, dict], stream: tuple[str, int] | None = None, rebase: bool = True) -> int:
    """Name the changed entries in a new version built on base. An entry of buckets holds those that changed."""
    while True:
        now = manifest(spark, root)
        if now["version"] != base:
            then = manifest(spark, root, base)
            for name, entry in changed.items():
                old, new = then["tables"].get(name), now["tables"].get(name)
                if old != new:
                    ours = entry["buckets"] if "buckets" in entry and new and old and "buckets" in new and "buckets" in old else None
                    if not rebase or ours is None or any(old["buckets"].get(b) != new["buckets"].get(b) for b in ours):
                        raise Conflict(f"{name} changed between versions {base} and {now['version']}")
        tables = dict(now["tables"])
        for name, entry in changed.items():
            kept = tables.get(name, {}).get("buckets", {}) if "buckets" in entry else {}
            tables[name] = entry | ({"buckets": {b: f for b, f in (kept | entry["buckets"]).items() if f}} if "buckets" in entry else {})
        version = now["version"] + 1
        streams = now["streams"] | ({stream[0]: stream[1]} if stream else {})
        text = json.dumps({"version": version, "built_on": base, "published_at": time.time(), "tables": tables, "streams": streams})
        if _put_if_absent(spark, f"{root}/_manifest/{version:012}.json", text):
            return version


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, built_on: int | None = None) -> int:
    """Write every table whole and publish them as one version: readers see all or nothing (SNK-1).

    built_on: the version that the tables were computed from; if another publisher has changed one of them since, Conflict. None takes the newest.
    """
    base = max(versions(spark, root), default=0) if built_on is None else built_on
    folder = f"data/{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{root}/{folder}/{name}")
    return _publish(spark, root, base, {name: {"path": f"{folder}/{name}", "schema": df.schema.json()} for name, df in tables.items()})


def _read(spark: SparkSession, root: str, entry: dict, buckets: list[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    if "path" in entry:
        return spark.read.schema(schema).parquet(f"{root}/{entry['path']}")
    folders = [f"{root}/{f}/{_BUCKET}={b}" for b, f in entry["buckets"].items() if buckets is None or b in buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def current(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """The table in a version, the newest if None."""
    tables = manifest(spark, root, version)["tables"]
    if name not in tables:
        raise LookupError(f"no version of {name} in {root}")
    return _read(spark, root, tables[name])


def _bucket_of(keys: list[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")


def _write_buckets(rows: DataFrame, root: str, name: str, keys: list[str], count: int, deal: bool = False) -> str:
    """Write rows by bucket; `deal` gathers those of a bucket first, in as many tasks as their size asks for."""
    folder = f"data/{uuid.uuid4().hex}/{name}"
    placed = rows.withColumn(_BUCKET, _bucket_of(keys, count))
    (placed.hint("rebalance", F.col(_BUCKET)) if deal else placed).write.partitionBy(_BUCKET).parquet(f"{root}/{folder}")
    return folder


def _merged(old: DataFrame, batch: DataFrame, keys: list[str], policy: dict | None) -> DataFrame:
    """apply_upsert without a full outer join: old rows meet the batch, then the batch's new rows are added.

    Old rows are the streamed side of both joins; Spark broadcasts the batch while its stored size allows.
    """
    b = batch.withColumn("_met", F.lit(True)).alias("b")
    met = old.alias("t").join(b, [F.col(f"t.{k}") == F.col(f"b.{k}") for k in keys], "left")
    values = [F.col(f"t.{c}") if c in keys else F.when(F.col("b._met"), _value(c, batch, (policy or {}).get(c, "overwrite"))).otherwise(F.col(f"t.{c}")).alias(c) for c in old.columns]
    known = stored(old.select(*keys).join(batch.select(*keys), keys, "left_semi"), "upsert-known")
    return met.select(*values).unionByName(apply_upsert(old.filter(F.lit(False)), batch.join(known, keys, "left_anti"), keys, policy))


def _value(c: str, batch: DataFrame, how: str | Column) -> Column:
    """What an updated row has in a column, by apply_upsert's policies."""
    if isinstance(how, Column):
        return how
    old = F.col(f"t.{c}")
    if c not in batch.columns or how == "keep":
        return old
    fresh = F.col(f"b.{c}")
    if how == "keep_non_null":
        return F.coalesce(fresh, old)
    return F.coalesce(old, F.lit(False)) | F.coalesce(fresh, F.lit(False)) if how == "or" else fresh


def create_buckets(spark: SparkSession, root: str, name: str, rows: DataFrame, keys: list[str], count: int = BUCKETS) -> int:
    """Publish a table in buckets of the hash of its keys."""
    base = max(versions(spark, root), default=0)
    folder = _write_buckets(rows, root, name, keys, count, deal=True)
    return _publish(spark, root, base, {name: _entry(spark, root, folder, rows, keys, count)})


def _entry(spark: SparkSession, root: str, folder: str, rows: DataFrame, keys: list[str], count: int, touched: list[str] | None = None) -> dict:
    """The manifest's entry of written buckets; touched ones that nothing was written to are empty now."""
    path, fs = _fs(spark, f"{root}/{folder}")
    written = [s.getPath().getName() for s in fs.listStatus(path)]
    buckets = dict.fromkeys(touched or []) | {n.removeprefix(f"{_BUCKET}="): folder for n in written if n.startswith(f"{_BUCKET}=")}
    return {"keys": keys, "count": count, "schema": rows.schema.json(), "buckets": buckets}


def upsert(spark: SparkSession, root: str, name: str, batch: DataFrame, keys: list[str], policy: dict | None = None, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None, stream: tuple[str, int] | None = None, attempts: int = 5, count: int = BUCKETS) -> int | None:
    """Merge a batch of unique, non-null keys into a bucketed table (created if absent) and publish it; the new version, None for an empty batch.

    merge(old rows of the touched buckets, batch) replaces apply_upsert's policies. stream: name and number of a micro-batch, which is merged once
    however often it comes. A conflict makes the merge anew on the newest version, up to `attempts` times.
    """
    batch = stored(batch, "upsert-batch")
    for left in range(attempts, 0, -1):
        now = manifest(spark, root)
        if stream and now["streams"].get(stream[0], -1) >= stream[1]:
            return None
        entry = now["tables"].get(name)
        count = entry["count"] if entry else count
        touched = [str(r[0]) for r in batch.select(_bucket_of(keys, count)).distinct().collect()]  # as many as there are buckets, at most
        if not touched and not stream:
            return None
        if not entry or not touched:
            rows = batch
        else:
            old = _read(spark, root, entry, touched)
            rows = merge(old, batch) if merge else _merged(old, batch, keys, policy)
        try:
            changed = {}
            if touched or not entry:
                folder = _write_buckets(rows, root, name, keys, count, deal=not entry)
                changed[name] = _entry(spark, root, folder, rows, keys, count, touched)
            return _publish(spark, root, now["version"], changed, stream)
        except Conflict:
            if left == 1:
                raise
    return None


def collect(spark: SparkSession, root: str, keep: int = 2, older_than: float = 86_400) -> list[str]:
    """Delete manifests but the newest `keep`, and data folders that none of those names and that were written `older_than` seconds ago or earlier:
    a publisher that has not finished needs its own. Returns the deleted folders."""
    known = versions(spark, root)
    for version in known[:-keep]:
        path, fs = _fs(spark, f"{root}/_manifest/{version:012}.json")
        fs.delete(path, False)
    used = set()
    for version in known[-keep:]:
        for entry in manifest(spark, root, version)["tables"].values():
            used |= {entry["path"]} if "path" in entry else {f"{f}/{_BUCKET}={b}" for b, f in entry["buckets"].items()}
    data, fs = _fs(spark, f"{root}/data")
    gone, limit = [], (time.time() - older_than) * 1000
    for run in fs.listStatus(data) if fs.exists(data) else []:
        for table in fs.listStatus(run.getPath()):
            name = f"data/{run.getPath().getName()}/{table.getPath().getName()}"
            parts = {f"{name}/{s.getPath().getName()}": s for s in fs.listStatus(table.getPath()) if s.isDirectory()}
            if name not in used and not used & set(parts):
                parts = {name: table}
            for folder, status in parts.items():
                if name not in used and folder not in used and status.getModificationTime() <= limit:
                    fs.delete(status.getPath(), True)
                    gone.append(folder)
    return gone
