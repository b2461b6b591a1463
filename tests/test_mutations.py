from pyspark.sql import functions as F

from harborlight.operators import guards, mutations, quality, runlog


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


SCHEMA = "k int, a string, flag boolean, updated_at string"


def test_upsert_policies_and_idempotence(spark):
    target = frame(spark, [(1, "x", True, "old"), (2, "y", False, "old"), (3, "z", None, "old")], SCHEMA)
    batch = frame(spark, [(1, None, False), (2, "y", False), (4, "n", None)], "k int, a string, flag boolean")
    once = mutations.apply_upsert(target, batch, ["k"], {"a": "keep_non_null", "flag": "or"}, stamp=F.lit("new"))
    assert rows(once, "k") == [(1, "x", True, "old"), (2, "y", False, "old"), (3, "z", None, "old"), (4, "n", None, "new")]
    plain = mutations.apply_upsert(target, batch, ["k"], stamp=F.lit("new"))
    assert rows(plain, "k")[0] == (1, None, False, "new") and rows(plain, "k")[1] == (2, "y", False, "old")
    assert rows(mutations.apply_upsert(plain, batch, ["k"], stamp=F.lit("later")), "k") == rows(plain, "k")


def test_upsert_of_nothing(spark):
    target = frame(spark, [(1, "x", True, "old")], SCHEMA)
    assert rows(mutations.apply_upsert(target, target.limit(0), ["k"])) == rows(target)
    assert rows(mutations.apply_upsert(target.limit(0), target, ["k"])) == rows(target)


def test_last_write(spark):
    batch = frame(spark, [(1, "a", 1, 1), (1, "b", 2, 1), (1, "c", 1, 9)], "k int, a string, page int, ordinal int")
    assert rows(mutations.last_write(batch, ["k"], ["page", "ordinal"]).select("k", "a")) == [(1, "b")]


def test_replace_children_with_none(spark):
    target = frame(spark, [("p", 1), ("p", 2), ("q", 1)], "p string, n int")
    new = frame(spark, [("r", 1)], "p string, n int")
    parents = frame(spark, [("p",), ("r",)], "p string")
    assert rows(mutations.replace_children(target, new, parents, "p")) == [("q", 1), ("r", 1)]


def test_deactivate_is_idempotent(spark):
    spots = frame(spark, [("a", True, None), ("b", True, None), ("c", False, "1")], "content_id string, is_active boolean, inactive_since string")
    after, ids = mutations.deactivate(spots, F.col("content_id") != "b", F.lit("now"))
    assert rows(after) == [("a", False, "now"), ("b", True, None), ("c", False, "1")] and rows(ids) == [("a",)]
    again, none = mutations.deactivate(after, F.col("content_id") != "b", F.lit("later"))
    assert rows(again) == rows(after) and none.count() == 0


def test_deactivate_unlisted(spark):
    spots = frame(spark, [("a", True, None), ("b", True, None)], "content_id string, is_active boolean, inactive_since string")
    after, ids = mutations.deactivate_unlisted(spots, frame(spark, [("a",), ("a",)], "content_id string"), F.lit(True), F.lit("now"))
    assert rows(after) == [("a", True, None), ("b", False, "now")] and rows(ids) == [("b",)]


def test_small_changes(spark):
    t = frame(spark, [(1, "x"), (2, "y")], "k int, v string")
    assert rows(mutations.prune(t, frame(spark, [(2,)], "k int"), "k")) == [(2, "y")]
    assert rows(mutations.insert_absent(t, frame(spark, [(2, "n"), (3, "m")], "k int, v string"), ["k"])) == [(1, "x"), (2, "y"), (3, "m")]
    assert rows(mutations.set_columns(t, frame(spark, [(1, None)], "k int, v string"), "k", ["v"])) == [(1, None), (2, "y")]
    assert rows(mutations.existing_or_null(t, "v", frame(spark, [("x",), ("x",)], "id string"), "id")) == [(1, "x"), (2, None)]
    assert rows(mutations.orphans(t, "v", frame(spark, [("x",)], "id string"), "id").select("k")) == [(2,)]
    dated = frame(spark, [(1, "2024-01-01"), (2, "2024-01-09")], "k int, base_ymd string").withColumn("base_ymd", F.col("base_ymd").cast("date"))
    assert rows(mutations.purge_before(dated, F.lit("2024-01-15").cast("date")).select("k")) == [(2,)]


def test_require_source(spark):
    t = frame(spark, [("tourapi",), ("other",)], "source string")
    try:
        mutations.require_source(t, "source", "tourapi").collect()
        raise AssertionError("accepted")
    except Exception as error:  # noqa: BLE001
        assert "source not allowed" in str(error)


def test_write_matches(spark):
    schema = "food_place_id long, spot_content_id string, match_score double, match_status string, match_method string"
    target = frame(spark, [(1, "a", 0.9, "matched", "rule"), (1, "m", 1.0, "matched", "manual"), (2, "b", 0.9, "matched", "rule"), (3, "c", 1.0, "matched", "manual")], schema)
    decided = frame(spark, [(1, "z", 0.5, "separate"), (3, "c", 0.9, "matched")], "food_place_id long, spot_content_id string, match_score double, match_status string")
    out = mutations.write_matches(target, decided)
    assert rows(out.orderBy("food_place_id").select("food_place_id", "spot_content_id", "match_method"), "food_place_id", "match_method") == [(1, "m", "manual"), (1, None, "rule"), (2, "b", "rule"), (3, "c", "rule")]


def test_deactivation_gate(spark):
    base = {"stopped_by_budget": False, "complete": True, "fetched": 100, "failed": 0, "active_count": 100, "candidate_count": 1}
    cases = [({}, None), ({"stopped_by_budget": True, "complete": False}, "stopped_by_budget"), ({"complete": False}, "partial_sync"), ({"failed": 5}, "high_failure_rate"), ({"candidate_count": 20}, "high_deactivation_ratio"), ({"active_count": 0, "candidate_count": 0}, None), ({"fetched": 0, "failed": 1}, "high_failure_rate")]
    for change, reason in cases:
        row = spark.createDataFrame([base | change])
        assert guards.decide(row, guards.deactivation_reason({c: F.col(c) for c in row.columns}))[0] == reason


def test_cache_gate(spark):
    base = {"run_id": 1, "complete": True, "stopped_by_budget": False, "fetched": 100, "upserted": 100, "failed": 0, "unmatched": 10}
    for change, reason in [({}, None), ({"complete": False, "stopped_by_budget": True}, "partial_sync"), ({"stopped_by_budget": True}, "stopped_by_budget"), ({"failed": 5}, "high_failure_rate"), ({"unmatched": 30}, "high_null_ratio")]:
        row = spark.createDataFrame([base | change])
        assert guards.decide(row, guards.cache_reason({c: F.col(c) for c in row.columns}))[0] == reason
    row = spark.createDataFrame([base | {"unmatched": 20}])
    assert guards.decide(row, guards.cache_reason({c: F.col(c) for c in row.columns}, min_match=0.9))[0] == "low_match_rate"
    assert guards.decide(row.limit(0), F.lit(None).cast("string"))[0] == "no_previous_sync"


def test_listing_complete(spark):
    """A type is read to its end by a page that is not full; one that was never read is not complete."""
    pages = spark.createDataFrame([("12", 1, 5), ("12", 2, 3), ("39", 1, 5)], "content_type_id string, page int, items int")
    assert not guards.listing_complete(pages, ["12", "39"], 5).first().complete
    assert guards.listing_complete(pages, ["12"], 5).first().complete
    assert not guards.listing_complete(pages, ["12", "14"], 5).first().complete
    assert not guards.listing_complete(pages.limit(0), ["12"], 5).first().complete


def test_run_log(spark):
    start = runlog.start_row(spark, 7, "j", None)
    import datetime

    end = runlog.end_row(spark, 7, "j", None, datetime.datetime(2024, 1, 1), "success", 3, 2, 1, {"a": 1})
    one = runlog.latest(start.unionByName(end)).first()
    assert (one.status, one.fetched, one.metadata) == ("success", 3, '{"a": 1}')
    assert runlog.last_success(start.unionByName(end), "fetched").first().fetched == 3


def test_quality_rules(spark):
    t = frame(spark, [(1, "39", -1, None), (1, "99", 5, "x")], "k int, content_type_id string, price int, v string")
    assert [r.value for r in quality.domain(t, "spots", "content_type_id", "k").collect()] == ["99"]
    assert [r.value for r in quality.in_range(t, "menus", "price", "k").collect()] == ["-1"]
    assert quality.unique(t, "t", ["k"]).first().value == "2"
    assert quality.required(t, "t", "v", "k").count() == 1
    try:
        quality.check_fields(t, ["k"])
        raise AssertionError("accepted")
    except ValueError:
        pass
