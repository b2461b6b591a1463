import datetime
import json

import pytest
from pyspark.sql import functions as F

from harborlight.plans import jobs
from harborlight.operators import mutations, normalize, runlog
from harborlight.sources import csv_records, files

AT = datetime.datetime(2024, 1, 2)
OLD = datetime.datetime(2023, 12, 1)


def test_spots_sync_and_gate(spark):
    schema = "content_id string, content_type_id string, title string, l_dong_regn_cd string, source_tour_api boolean, source_busan_food boolean, source_modified_time timestamp, synced_at timestamp, is_active boolean, inactive_since timestamp"
    spots = spark.createDataFrame([("1", "39", "old", "26", True, True, OLD, OLD, True, None), ("2", "39", "same", "26", True, False, OLD, AT, True, None), ("3", "39", "gone", "26", True, False, OLD, OLD, True, None)], schema)
    filler = spark.range(10, 30).select(*[F.lit(v).cast(t).alias(n) if n != "content_id" else F.col("id").cast("string").alias(n) for n, t, v in [("content_id", "string", None), ("content_type_id", "string", "39"), ("title", "string", "t"), ("l_dong_regn_cd", "string", "26"), ("source_tour_api", "boolean", True), ("source_busan_food", "boolean", False), ("source_modified_time", "timestamp", OLD), ("synced_at", "timestamp", AT), ("is_active", "boolean", True), ("inactive_since", "timestamp", None)]])
    tables = {
        "spots": spots.unionByName(filler),
        "details": spark.createDataFrame([], "content_id string, overview string, overview_hash string"),
        "raw": spark.createDataFrame([], "content_id string, raw_json string, fetched_at timestamp"),
        "images": spark.createDataFrame([("1", "9", "u", None, None, None)], "content_id string, serial_num string, origin_img_url string, small_img_url string, img_name string, cpyrht_div_cd string"),
    }
    listed = spark.createDataFrame([("1", AT), ("2", OLD), ("4", AT)], "content_id string, source_modified_time timestamp")
    # listed and unchanged, so not read again: they are not missing
    listing = listed.unionByName(filler.select("content_id", "source_modified_time"))
    body = lambda i, t: json.dumps({"response": {"body": {"items": {"item": {"contentid": i, "contenttypeid": "39", "title": t, "lDongRegnCd": "26", "modifiedtime": "20240102090000"}}}}})
    landed = spark.createDataFrame([("1", "detailCommon2", body("1", "new")), ("2", "detailCommon2", body("2", "changed")), ("4", "detailCommon2", body("4", "fresh"))], "content_id string, endpoint string, payload string")
    run = {"region": "26", "types": ["39"], "stopped_by_budget": False, "complete": True, "fetched": 3, "failed": 0}
    out = jobs.spots_sync(tables, listing, landed, run, F.lit(AT))
    got = {r.content_id: (r.title, r.is_active, r.source_busan_food) for r in out["spots"].filter("content_id < '5' and length(content_id) = 1").collect()}
    assert got == {"1": ("new", True, True), "2": ("same", True, False), "3": ("gone", False, False), "4": ("fresh", True, None)}
    assert out["spots"].filter("is_active").count() == 23
    assert out["images"].count() == 0 and out["raw"].count() == 2
    blocked = jobs.spots_sync(tables, listing, landed, run | {"complete": False}, F.lit(AT))
    assert "deactivated" not in blocked and blocked["metrics"].first().deactivation_skip_reason == "partial_sync"


def test_congestion_chain(spark):
    spots = spark.createDataFrame([("s1", "절 (중구)", "110", True, 1.0, None, None), ("s2", "숲", "110", True, 2.0, None, None)], "content_id string, title string, l_dong_signgu_cd string, is_active boolean, today_concentration_rate double, upcoming_avg_rate decimal(5,2), congestion_updated_at timestamp")
    empty = spark.createDataFrame([], "content_id string, area_cd string, signgu_cd string, raw_tats_name string, base_ymd date, rate double, level int, source string")
    item = lambda n, d, r: {"areaCd": "26", "signguCd": "26110", "tAtsNm": n, "baseYmd": d, "cnctrRate": r}
    payload = json.dumps({"response": {"body": {"items": {"item": [item("절", "20240102", "30"), item("절", "20240103", "50"), item("절", "20240104", "61"), item("강", "20240102", "9")]}}}}, ensure_ascii=False)
    landed = spark.createDataFrame([(payload, AT)], "payload string, fetched_at timestamp")
    out = jobs.congestion_sync({"spots": spots, "forecast": empty}, landed)
    m = out["metrics"].first()
    assert (m.fetched, m.unmatched, m.match_rate) == (4, 1, 0.75)
    last = spark.createDataFrame([(1, True, False, 4, 4, 0, 1)], "run_id long, complete boolean, stopped_by_budget boolean, fetched long, upserted long, failed long, unmatched long")
    tables = {"spots": spots, "forecast": out["forecast"]}
    after = jobs.cache_refresh(tables, last, F.lit("2024-01-02").cast("date"), F.lit(AT))["spots"]
    assert {r.content_id: (r.today_concentration_rate, r.upcoming_avg_rate and float(r.upcoming_avg_rate)) for r in after.collect()} == {"s1": (30.0, 55.5), "s2": (2.0, None)}
    stopped = jobs.cache_refresh(tables, last.withColumn("unmatched", F.lit(3)), F.lit("2024-01-02").cast("date"), F.lit(AT))
    assert stopped["metrics"].first().cache_skip_reason == "high_null_ratio"
    assert jobs.congestion_purge(tables, F.lit("2024-01-11").cast("date"))["forecast"].count() == 1


def test_price_summary_cases(spark):
    menus = spark.createDataFrame([(1, "b", 5000, 2, False), (1, "a", 6000, 1, True), (2, "c", 8500, None, False), (2, "z", None, 1, True), (2, "free", 0, 1, True), (3, "n", 100, 1, True)], "food_place_id long, menu_name string, price int, display_order int, is_representative boolean")
    matches = spark.createDataFrame([(1, "s", "matched"), (2, "s", "matched"), (3, "t", "pending")], "food_place_id long, spot_content_id string, match_status string")
    empty = spark.createDataFrame([("old", 1, 1, "m", 1, 1, 1)], "spot_content_id string, min_price int, avg_price int, representative_menu_name string, representative_price int, menu_count int, food_place_count int")
    out = jobs.price_summary_refresh({"menus": menus, "matches": matches, "summary": empty}, prune=True)["summary"]
    assert [tuple(r) for r in out.collect()] == [("s", 5000, 6500, "a", 6000, 3, 2)]
    kept = jobs.price_summary_refresh({"menus": menus, "matches": matches, "summary": empty})["summary"]
    assert kept.count() == 2


def test_place_geocode(spark):
    places = spark.createDataFrame([(1, "부산 중구 1", None, None, True), (2, "서울", None, None, True), (3, "부산", 1.0, 2.0, True)], "id long, address string, map_x double, map_y double, is_active boolean")
    responses = spark.createDataFrame([("부산광역시 중구 1", '{"documents":[{"x":"129.1","y":"35.1"}]}')], "query string, payload string")
    out = jobs.place_geocode({"places": places}, responses)
    assert {r.id: r.map_x for r in out["places"].collect()} == {1: 129.1, 2: None, 3: 1.0}
    m = out["metrics"].first()
    assert (m.scanned, m.resolved, m.failed) == (2, 1, 1)


def test_spots_sync_from_pages(spark):
    """Ids as texts and numbers, an item without one, a type whose last page was not read."""
    schema = "content_id string, content_type_id string, title string, l_dong_regn_cd string, source_tour_api boolean, source_busan_food boolean, source_modified_time timestamp, synced_at timestamp, is_active boolean, inactive_since timestamp"
    rows = [(str(i), "39", "t", "26", True, False, OLD, OLD, True, None) for i in range(1, 12)]
    tables = {
        "spots": spark.createDataFrame(rows, schema),
        "details": spark.createDataFrame([], "content_id string, overview string"),
        "raw": spark.createDataFrame([], "content_id string, raw_json string, fetched_at timestamp"),
        "images": spark.createDataFrame([], "content_id string, serial_num string, origin_img_url string"),
    }
    page = lambda items: json.dumps({"response": {"body": {"items": {"item": items}}}})
    stamp = "20231201090000"
    first = [{"contentid": i, "modifiedtime": stamp} for i in range(1, 6)]
    second = [{"contentid": str(i), "modifiedtime": stamp} for i in range(6, 11)] + [{"modifiedtime": stamp}]
    pages = [("39", 1, page(first)), ("39", 2, page(second)), ("39", 3, page([])), ("12", 1, page({"contentid": 99}))]
    details = spark.createDataFrame([], "content_id string, endpoint string, payload string")
    run = {"region": "26", "types": ["39", "12"], "stopped_by_budget": False}
    landed = spark.createDataFrame(pages, "content_type_id string, page int, payload string")
    out = jobs.JOBS["tourapi_spots_sync"](tables, landed, details, run, F.lit(AT), page_rows=5)
    m = out["metrics"].first()
    assert (m.fetched, m.skip_invalid_count, m.complete, m.candidate_count, m.deactivation_skip_reason) == (12, 1, True, 1, None)
    assert [r.content_id for r in out["spots"].filter("not is_active").collect()] == ["11"] and out["rejects"].count() == 1
    unread = jobs.JOBS["tourapi_spots_sync"](tables, landed.filter("page < 2 and content_type_id = '39'"), details, run, F.lit(AT), page_rows=5)
    assert unread["metrics"].first().deactivation_skip_reason == "partial_sync" and unread["spots"].filter("is_active").count() == 11


FOOD = {
    "places": "id long, name string, tel string, is_active boolean",
    "sources": "source string, external_id string, food_place_id long, raw_json string, fetched_at timestamp",
    "menus": "food_place_id long, menu_name string, price int, display_order int, is_representative boolean, source string",
    "observations": "food_place_id long, menu_name string, observed_price int, observed_at timestamp",
}


def food_tables(spark):
    return {n: spark.createDataFrame([], s) for n, s in FOOD.items()}


def test_menu_rows_of_one_store_all_count(spark):
    """Rows of a store share its id; each gives its menu and observation, later rows of a menu its price; equal times do not matter."""
    row = lambda store, menu, price: {"bsshNm": store, "itemNm": menu, "menuPrc": price}
    pages = [(1, [row("Straße", "a", "1000"), row("STRASSE", "b", "2000"), row("straße", "a", "1500")]), (2, [row("strasse", "c", "x"), row("other", "a", "700"), {"itemNm": "nameless"}, row("모텔 x", "a", "1")])]
    landed = spark.createDataFrame([(p, json.dumps({"items": items}, ensure_ascii=False), AT) for p, items in pages], "page int, payload string, fetched_at timestamp").repartition(3)
    out = jobs.JOBS["good_price_menu_sync"](food_tables(spark), landed)
    ids = {r.external_id: r.food_place_id for r in out["sources"].collect()}
    assert set(ids) == {"bsshNm:strasse", "bsshNm:other"}
    menus = {(r.food_place_id, r.menu_name): r.price for r in out["menus"].collect()}
    a, b = ids["bsshNm:strasse"], ids["bsshNm:other"]
    assert menus == {(a, "a"): 1500, (a, "b"): 2000, (a, "c"): None, (b, "a"): 700}
    assert sorted((r.menu_name, r.observed_price) for r in out["observations"].collect()) == [("a", 700), ("a", 1000), ("a", 1500), ("b", 2000)]
    assert sorted(r.name for r in out["places"].collect()) == ["other", "strasse"]
    assert out["metrics"].first().asDict() == {"fetched": 7, "upserted": 5, "failed": 1, "skipped_keyword_count": 1}


def test_new_ids_do_not_collide(spark):
    """A known id that is some new key's hash, and no merging of stores."""
    places = spark.createDataFrame([("s", str(i), AT) for i in range(50)], "source string, external_id string, fetched_at timestamp")
    none = spark.createDataFrame([], "source string, external_id string, food_place_id long")
    plain = {r.external_id: r.food_place_id for r in normalize.assign_ids(places, none).collect()}
    assert len(set(plain.values())) == 50 and all(v > 0 for v in plain.values())
    known = spark.createDataFrame([("other", "x", plain["7"]), ("s", "8", 123)], "source string, external_id string, food_place_id long")
    again = {r.external_id: r.food_place_id for r in normalize.assign_ids(places, known).collect()}
    assert again["8"] == 123 and again["7"] not in plain.values()
    assert {k: v for k, v in again.items() if k not in ("7", "8")} == {k: v for k, v in plain.items() if k not in ("7", "8")}


def test_file_import_numbers_rows(spark, tmp_path):
    """Row numbers of rejects count from 2 in each file, over several blocks."""
    for name, bad in (("a", 4000), ("b", 2)):
        lines = ["\ufeff업소명,연락처"] + [f"{'' if i == bad else f'{name}{i}'},051" for i in range(2, 6000)]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = csv_records.read_csv_rows(spark, str(tmp_path / "*.csv"))
        out = jobs.JOBS["good_price_file_import"](food_tables(spark), rows, F.lit(AT))
        assert sorted(r.ordinal for r in out["rejects"].collect()) == [2, 4000]
        assert out["metrics"].first().failed == 2 and out["places"].count() == 2 * 5998 - 2
        names = {r.cells[0]: r.row_number for r in rows.collect()}
        assert all(names[f"a{i}"] == i for i in range(2, 6000) if i != 4000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_run_job_logs_and_publishes(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = json.dumps({"items": [{"bsshNm": "s", "itemNm": "m", "menuPrc": "5"}, {"itemNm": "nameless"}]})
    landed = spark.createDataFrame([(rows, AT)], "payload string, fetched_at timestamp")
    jobs.run_job(spark, root, "good_price_menu_sync", 1, food_tables(spark), landed, dry_run=True)
    with pytest.raises(Exception):  # noqa: B017 nothing is published by a dry run
        files.current(spark, root, "places")
    jobs.run_job(spark, root, "good_price_menu_sync", 2, food_tables(spark), landed, run_type="scheduled")
    assert files.current(spark, root, "menus").first().price == 5
    with pytest.raises(KeyError):
        jobs.run_job(spark, root, "good_price_menu_sync", 3, {}, landed)
    log = {r.id: r for r in runlog.latest(runlog.read(spark, root)).collect()}
    assert {i: r.status for i, r in log.items()} == {1: "success", 2: "success", 3: "failed"}
    assert (log[2].fetched, log[2].upserted, log[2].failed, log[2].run_type) == (2, 1, 1, "scheduled")
    figures = json.loads(log[2].metadata)
    assert figures["skipped_keyword_count"] == 0 and len(figures["errors"]) == 1 and json.loads(log[1].metadata)["dry_run"]
    assert "error_message" in json.loads(log[3].metadata)


def test_cascade_keeps_rows_without_parent(spark):
    children = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, parent string")
    parents = spark.createDataFrame([("a",), ("a",), (None,)], "key string")
    assert sorted(r.id for r in mutations.cascade(children, "parent", parents, "key").collect()) == [1, 3]
