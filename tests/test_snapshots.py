"""Published versions, buckets and the streams that keep them current."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from harborlight.operators import mutations
from harborlight.session import stored
from harborlight.sources import files
from harborlight.streaming.observations import current_prices
from harborlight.streaming.snapshots import run_incremental

ROWS = "k int, v string, w string, f boolean"


def as_set(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, rows, schema="k int, v string"):
    return spark.createDataFrame(rows, schema)


def test_versions_and_conflicts(spark, tmp_path):
    """Two publishers from one version: other tables rebase, the same table is a conflict; versions stay readable."""
    root = str(tmp_path / "s")
    with pytest.raises(LookupError):
        files.current(spark, root, "a")
    assert files.publish(spark, {"a": frame(spark, [(1, "x")]), "b": frame(spark, [(1, "x")])}, root) == 1
    assert files.publish(spark, {"a": frame(spark, [(1, "y")])}, root, built_on=1) == 2
    assert files.publish(spark, {"b": frame(spark, [(1, "z")])}, root, built_on=1) == 3
    with pytest.raises(files.Conflict):
        files.publish(spark, {"a": frame(spark, [(1, "lost")])}, root, built_on=1)
    assert [files.current(spark, root, "a", v).first().v for v in (1, 2, 3)] == ["x", "y", "y"]
    assert files.current(spark, root, "b").first().v == "z" and files.versions(spark, root) == [1, 2, 3]


def test_crash_before_manifest(spark, tmp_path, monkeypatch):
    """Data without a manifest is not seen, and is deleted later."""
    root = str(tmp_path / "s")
    files.publish(spark, {"a": frame(spark, [(1, "x")])}, root)

    def crash(*_, **__):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(files, "_put_if_absent", crash)
        with pytest.raises(OSError, match="gone"):
            files.publish(spark, {"a": frame(spark, [(1, "y")])}, root)
    assert files.current(spark, root, "a").first().v == "x"
    assert files.collect(spark, root) == []  # too young
    assert len(files.collect(spark, root, older_than=0)) == 1 and files.current(spark, root, "a").first().v == "x"


def test_lost_race_is_rebased(spark, tmp_path, monkeypatch):
    """Another publisher takes the number between look and put."""
    root = str(tmp_path / "s")
    real, rivals = files._put_if_absent, [1]

    def slow(session, where, text):
        if rivals:
            rivals.clear()
            files.publish(session, {"other": frame(session, [(9, "o")])}, root)
        return real(session, where, text)

    monkeypatch.setattr(files, "_put_if_absent", slow)
    assert files.publish(spark, {"a": frame(spark, [(1, "x")])}, root) == 2
    assert files.current(spark, root, "other").first().k == 9 and files.current(spark, root, "a").first().k == 1
    assert not real(spark, f"{root}/_manifest/{2:012}.json", "{}")


def test_upsert_rewrites_touched_buckets(spark, tmp_path):
    root = str(tmp_path / "s")
    start = frame(spark, [(i, "old", None, None) for i in range(1000)], ROWS)
    files.create_buckets(spark, root, "t", start, ["k"])
    before = files.manifest(spark, root)["tables"]["t"]["buckets"]
    assert len(before) == 64
    batch = frame(spark, [(i * 90, "new", "w", True) for i in range(8)] + [(5000, "new", None, None), (5001, "new", None, None)], ROWS)
    assert files.upsert(spark, root, "t", batch, ["k"]) == 2
    after = files.manifest(spark, root)["tables"]["t"]["buckets"]
    changed = [b for b in after if after[b] != before.get(b)]
    assert 0 < len(changed) <= 10
    assert as_set(files.current(spark, root, "t")) == as_set(mutations.apply_upsert(start, batch, ["k"]))
    assert files.current(spark, root, "t", 1).count() == 1000
    for _ in range(2):
        files.upsert(spark, root, "t", batch, ["k"])
    gone = files.collect(spark, root, keep=1, older_than=0)
    assert gone and files.versions(spark, root) == [4] and files.current(spark, root, "t").count() == 1002
    assert files.upsert(spark, root, "t", batch.limit(0), ["k"]) is None
    plan = files._merged(files.current(spark, root, "t"), stored(batch, "batch"), ["k"], None)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan  # the target is joined where it lies


@pytest.mark.parametrize("policy", [None, {"w": "keep_non_null", "f": "or"}, {"v": "keep", "w": "coalesce(t.w, '-') || b.v"}])
def test_bucket_policies_equal_upsert(spark, tmp_path, policy):
    if policy and "||" in policy["w"]:
        policy = policy | {"w": F.expr(policy["w"])}
    root = str(tmp_path / "s")
    old = frame(spark, [(i, f"v{i}", "w" if i % 2 else None, i % 3 == 0) for i in range(30)], ROWS)
    batch = frame(spark, [(i, f"b{i}", None if i % 3 else "n", None if i % 2 else False) for i in range(20, 40)], ROWS)
    files.create_buckets(spark, root, "t", old, ["k"], count=8)
    files.upsert(spark, root, "t", batch, ["k"], policy)
    assert as_set(files.current(spark, root, "t")) == as_set(mutations.apply_upsert(old, batch, ["k"], policy))
    some = batch.select("k", "v")
    files.upsert(spark, root, "t", some.withColumn("k", F.col("k") + 100), ["k"])
    assert files.current(spark, root, "t").filter("k > 100 and w is null and f is null").count() == 20


def test_rival_upserts(spark, tmp_path, monkeypatch):
    """A rival in other buckets is kept; one in the same bucket makes the merge anew."""
    root = str(tmp_path / "s")
    files.create_buckets(spark, root, "t", frame(spark, [(i, "old") for i in range(200)]), ["k"], count=4)
    real, rivals = files._put_if_absent, [[(1, "rival")], [(300, "rival")]]

    def slow(session, where, text):
        if rivals:
            files.upsert(session, root, "t", frame(session, rivals.pop()), ["k"])
        return real(session, where, text)

    monkeypatch.setattr(files, "_put_if_absent", slow)
    files.upsert(spark, root, "t", frame(spark, [(i, "mine") for i in range(2, 60)]), ["k"])
    got = {r.k: r.v for r in files.current(spark, root, "t").collect()}
    assert got[1] == got[300] == "rival" and all(got[i] == "mine" for i in range(2, 60)) and len(got) == 201


def test_merge_that_empties_a_bucket(spark, tmp_path):
    root = str(tmp_path / "s")
    files.create_buckets(spark, root, "t", frame(spark, [(1, "a"), (2, "b")]), ["k"], count=1)
    files.upsert(spark, root, "t", frame(spark, [(1, "x")]), ["k"], merge=lambda old, batch: old.filter("false"))
    assert files.current(spark, root, "t").count() == 0


def test_incremental_landing(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    frame(spark, [(1, "a"), (2, "b")]).write.parquet(str(folder / "1"))

    def run():
        stream = spark.readStream.schema("k int, v string").option("recursiveFileLookup", "true").parquet(str(folder))
        run_incremental(stream, root, "t", ["k"], str(tmp_path / "cp"), count=4).awaitTermination()
        return {r.k: r.v for r in files.current(spark, root, "t").collect()}

    assert run() == {1: "a", 2: "b"}
    frame(spark, [(2, "c"), (3, "d")]).write.parquet(str(folder / "2"))
    assert run() == {1: "a", 2: "c", 3: "d"} == run()
    seen = files.versions(spark, root)
    assert files.upsert(spark, root, "t", frame(spark, [(2, "again")]), ["k"], stream=(str(tmp_path / "cp"), 1)) is None  # a batch that comes again
    assert files.versions(spark, root) == seen


def test_observations_restart_late_and_repeated(spark, tmp_path):
    """State comes back from the checkpoint; late rows of older prices, repeats and rows without time change nothing."""
    schema = "place int, menu string, price int, at timestamp, event long"
    day = lambda d: datetime.datetime(2024, 1, d)
    batches = [[(1, "m", 10, day(5), 1), (1, "m", 10, day(5), 1), (1, "m", 8, day(5), 0)], [(1, "m", 7, day(4), 2), (1, "n", 3, day(6), 3), (None, "m", 1, day(6), 4), (1, "n", 9, None, 5)], [(2, "m", 5, day(30), 6)], [(1, "m", 1, day(4), 7), (1, "n", None, day(31), 8)]]
    root, wanted = str(tmp_path / "out"), [{(1, "m"): 10}, {(1, "n"): 3}, {(2, "m"): 5}, {(1, "n"): None}]
    known = {}
    for number, (batch, new) in enumerate(zip(batches, wanted, strict=True)):
        spark.createDataFrame(batch, schema).write.parquet(str(tmp_path / "in" / str(number)))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        current_prices(stream, ["place", "menu"], "price", ["at", "event"], root, str(tmp_path / "cp"), count=2).awaitTermination()
        known |= new
        assert {(r.place, r.menu): r.price for r in files.current(spark, root, "prices").collect()} == known
    assert os.path.isdir(tmp_path / "cp" / "state")
