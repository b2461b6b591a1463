"""Registered queries that run whole jobs over tables and payloads derived from a folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight.functions.similarity import similarity_udf
from harborlight.operators import headers, mutations, normalize
from harborlight.plans import catalog_payloads as payloads
from harborlight.plans import jobs
from harborlight.plans.catalog import query
from harborlight.plans.catalog_payloads import at, envelope
from harborlight.session import shared_dir
from harborlight.sources import csv_records, files
from harborlight.streaming.snapshots import run_incremental

_MENUS = "food_place_id long, menu_name string, price int, display_order int, is_representative boolean, source string"
_OBSERVATIONS = "food_place_id long, menu_name string, observed_price int, source string, source_type string, observed_at timestamp"
_SOURCES = "source string, external_id string, food_place_id long, source_region string, raw_json string, fetched_at timestamp"
_PLACES = "id long, name string, address string, tel string, representative_menu string, normalized_category string, map_x double, map_y double, parking_available boolean, is_active boolean"


def _empty(t, schema: str) -> DataFrame:
    return t("region").sparkSession.createDataFrame([], schema)


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def food_tables(t, sources: DataFrame | None = None, places: DataFrame | None = None) -> jobs.Tables:
    kinds = {"places": _PLACES, "sources": _SOURCES, "menus": _MENUS, "observations": _OBSERVATIONS}
    return {n: _empty(t, k) for n, k in kinds.items()} | {n: df for n, df in (("sources", sources), ("places", places)) if df is not None}


def menu_pages(t) -> DataFrame:
    """Menu rows of stores, line by line: stores come on several rows and pages, menus repeat with other prices, some rows lack a name."""
    name = F.when(F.col("l_orderkey") % 29 == 0, " ").otherwise(F.concat(F.when(F.col("l_linenumber") % 2 == 0, "Store ").otherwise("store "), _text("l_suppkey")))
    item = F.struct(name.alias("bsshNm"), F.concat(F.lit("menu "), _text(F.col("l_partkey") % 5)).alias("itemNm"), F.when(F.col("l_linenumber") == 7, "x").otherwise(_text(F.floor("l_extendedprice"))).alias("menuPrc"), _text("l_orderkey").alias("order"))
    rows = t("lineitem").groupBy(F.col("l_orderkey").alias("page")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", item.alias("item")))).alias("rows"))
    return rows.select("page", envelope(F.transform("rows", lambda r: r["item"])).alias("payload"), at().alias("fetched_at"))


def _menu_sync(t) -> jobs.Tables:
    known = t("supplier").filter("s_suppkey % 2 = 0").select(F.lit("good_price_menu").alias("source"), F.concat(F.lit("bsshNm:store "), _text("s_suppkey")).alias("external_id"), F.col("s_suppkey").alias("food_place_id"), F.lit(None).cast("string").alias("source_region"), F.lit("old").alias("raw_json"), at().alias("fetched_at"))
    return jobs.JOBS["good_price_menu_sync"](food_tables(t, sources=known), menu_pages(t))


_ROWS = """with m as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as pos, 'menu ' || cast(l_partkey % 5 as varchar) as menu_name,
    case when l_linenumber <> 7 then cast(floor(l_extendedprice) as int) end as price, case when l_linenumber % 2 = 0 then 'Store ' else 'store ' end || cast(l_suppkey as varchar) as name from {lineitem} where l_orderkey % 29 <> 0) """


@query(_ROWS + """select cast(l_suppkey as varchar) as store, menu_name, price from (select *, row_number() over (partition by l_suppkey, menu_name order by l_orderkey desc, pos desc) as n from m) where n = 1""")
def menu_sync(t) -> DataFrame:
    """JOB good_price_menu_sync, PRJ-15, MUT-10: every row of a store gives its menu, the last row of a menu its price."""
    out = _menu_sync(t)
    ids = out["sources"].select("food_place_id", F.element_at(F.split("external_id", " "), -1).alias("store"))
    return out["menus"].join(ids, "food_place_id").select("store", "menu_name", "price")


@query(_ROWS + "select menu_name, price as observed_price, count(*) as n from m where price is not null group by 1, 2")
def menu_sync_observations(t) -> DataFrame:
    """MUT-11, GEN-9: every price of every row is an observation."""
    return _menu_sync(t)["observations"].groupBy("menu_name", "observed_price").agg(F.count("*").alias("n"))


@query(_ROWS + """select name, known from (select name, l_suppkey % 2 = 0 and l_suppkey in (select s_suppkey from {supplier}) as known, row_number() over (partition by l_suppkey order by l_orderkey desc, pos desc) as n from m) where n = 1""")
def menu_sync_places(t) -> DataFrame:
    """MUT-8, MUT-9, JN-9: one place for each store, known ones under their id."""
    out = _menu_sync(t)
    known = t("supplier").filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("id"), F.lit(True).alias("k"))
    return out["places"].join(known, "id", "left").select("name", F.coalesce("k", F.lit(False)).alias("known"))


@query(_ROWS + """select (select count(*) from {lineitem}) as fetched, (select count(*) from m) as upserted, (select count(*) from {lineitem} where l_orderkey % 29 = 0) as failed, 0 as skipped_keyword_count""")
def menu_sync_figures(t) -> DataFrame:
    """Counters of a food sync."""
    return _menu_sync(t)["metrics"]


def _flavour_rows(t, headers: dict[str, Column]) -> DataFrame:
    row = F.map_from_arrays(F.array(*[F.lit(h) for h in headers]), F.array(*headers.values()))
    return t("part").select(row.alias("row"), at().alias("fetched_at"), F.lit(0).alias("page"), F.col("p_partkey").alias("ordinal"))


def _key() -> Column:
    return F.col("p_partkey")


def _store() -> dict[str, Column]:
    """Headers of a store row: ids that repeat, and some blocked places."""
    return {"idx": _text(_key() % 150), "sj": F.concat(F.lit("s "), "p_name"), "adres": F.concat(F.lit("부산 "), "p_type"), "tel": F.lit("051 1"), "parkngAt": F.when(_key() % 2 == 0, "Y").otherwise("N"), "cn": F.when(_key() % 9 == 0, "숙박업").otherwise("한식")}


def _guide() -> dict[str, Column]:
    """Headers of a guide row, some without latitude."""
    return {"UC_SEQ": _text(_key()), "MAIN_TITLE": F.col("p_name"), "LNG": F.lit("129.1"), "LAT": F.when(_key() % 4 == 0, "x").otherwise("35.1"), "ADDR1": F.col("p_type"), "RPRSNTV_MENU": F.col("p_brand")}


_LAST = "(select * from (select *, p_partkey % 150 as idx, row_number() over (partition by p_partkey % 150 order by p_partkey desc) as n from {part} where p_partkey % 9 <> 0) where n = 1)"


@query(f"select 's ' || p_name as name, '부산 ' || p_type as address, '0511' as tel, p_partkey % 2 = 0 as parking_available, cast(null as varchar) as representative_menu from {_LAST}")
def store_sync(t) -> DataFrame:
    """JOB good_price_store_sync, PRJ-28, FLT-1: the last row of an id counts, blocked places are left out."""
    out = jobs.food_sync(food_tables(t), _flavour_rows(t, _store()), "store")
    return out["places"].select("name", "address", "tel", "parking_available", "representative_menu")


@query(f"select cast(p_partkey % 150 as varchar) as external_id, 'good_price_store' as source, cast(p_partkey as varchar) as row_key from {_LAST}")
def store_sync_sources(t) -> DataFrame:
    """MUT-9: the stored document is that of the last row."""
    out = jobs.food_sync(food_tables(t), _flavour_rows(t, _store() | {"key": _text(_key())}), "store")
    return out["sources"].select("external_id", "source", F.get_json_object("raw_json", "$.key").alias("row_key"))


@query("select p_partkey as id, case when p_partkey % 2 = 0 then p_name else 'old' end as name, case when p_partkey % 2 = 1 then 1.5 else 129.1 end as map_x, case when p_partkey % 2 = 1 then 2.5 when p_partkey % 4 <> 0 then 35.1 end as map_y, case when p_partkey % 2 = 1 then 'tel' end as tel from {part}")
def guide_sync(t) -> DataFrame:
    """JOB busan_food_sync, MUT-8: known places are overwritten, nulls included; the others stay."""
    known = t("part").select(F.lit("busan_food").alias("source"), _text(_key()).alias("external_id"), _key().alias("food_place_id"), F.lit(None).cast("string").alias("source_region"), F.lit("old").alias("raw_json"), at().alias("fetched_at"))
    none = F.lit(None).cast("string")
    places = t("part").select(_key().alias("id"), F.lit("old").alias("name"), none.alias("address"), F.lit("tel").alias("tel"), none.alias("representative_menu"), none.alias("normalized_category"), F.lit(1.5).alias("map_x"), F.lit(2.5).alias("map_y"), F.lit(None).cast("boolean").alias("parking_available"), F.lit(True).alias("is_active"))
    out = jobs.food_sync(food_tables(t, sources=known, places=places), _flavour_rows(t, _guide()).filter("ordinal % 2 = 0"), "guide")
    return out["places"].select("id", "name", "map_x", "map_y", "tel")


@query("select p_partkey as id, p_name as name, 'tel' as tel, case when p_partkey % 4 <> 0 then 35.1 else 2.5 end as map_y from {part}")
def guide_sync_keeping(t) -> DataFrame:
    """MUT-8 with keep_non_null: incoming nulls leave what is known."""
    known = t("part").select(F.lit("busan_food").alias("source"), _text(_key()).alias("external_id"), _key().alias("food_place_id"), F.lit(None).cast("string").alias("source_region"), F.lit("old").alias("raw_json"), at().alias("fetched_at"))
    none = F.lit(None).cast("string")
    places = t("part").select(_key().alias("id"), F.lit("old").alias("name"), none.alias("address"), F.lit("tel").alias("tel"), none.alias("representative_menu"), none.alias("normalized_category"), F.lit(1.5).alias("map_x"), F.lit(2.5).alias("map_y"), F.lit(None).cast("boolean").alias("parking_available"), F.lit(True).alias("is_active"))
    out = jobs.food_sync(food_tables(t, sources=known, places=places), _flavour_rows(t, _guide()), "guide", keep_non_null=True)
    return out["places"].select("id", "name", "tel", "map_y")


def _spot_tables(t) -> jobs.Tables:
    old = t("part").filter("p_partkey % 4 <> 3").select(_text(_key()).alias("content_id"), F.when(_key() % 2 == 0, "39").otherwise("12").alias("content_type_id"), F.lit("old").alias("title"), F.lit("26").alias("l_dong_regn_cd"), F.lit(True).alias("source_tour_api"), (_key() % 3 == 0).alias("source_busan_food"), F.when(_key() % 5 == 0, F.expr("to_timestamp(concat('2024-01-02 00:0', p_partkey % 10))")).alias("source_modified_time"), F.lit("2020-01-01").cast("timestamp").alias("synced_at"), F.lit(True).alias("is_active"), F.lit(None).cast("timestamp").alias("inactive_since"))
    return {"spots": old, "details": _empty(t, "content_id string, overview string, overview_hash string"), "raw": _empty(t, "content_id string, raw_json string, fetched_at timestamp"), "images": _empty(t, "content_id string, serial_num string, origin_img_url string, img_name string")}


_UNCHANGED = "p_partkey % 5 = 0 and p_partkey % 4 <> 3"
_LISTED = "p_partkey % 13 <> 0"
_GONE = "(select count(*) from {part} where p_partkey % 4 <> 3 and p_partkey % 13 = 0) / (select greatest(count(*), 1) from {part} where p_partkey % 4 <> 3 or p_partkey % 13 <> 0) < 0.2 and (select count(distinct p_partkey % 2) from (select p_partkey % 2 as p_partkey, count(*) as n from {part} group by floor(p_partkey / 80), p_partkey % 2) where n < 40) = 2"


@query(f"""select cast(p_partkey as varchar) as content_id, case when {_LISTED} and not ({_UNCHANGED}) then p_name else 'old' end as title, not ({_GONE} and p_partkey % 13 = 0) as is_active from {{part}} where p_partkey % 4 <> 3 or {_LISTED}""")
def spots_sync(t) -> DataFrame:
    """JOB tourapi_spots_sync, MUT-1, MUT-5, FLT-5, GRD-1: changed spots read, unlisted ones deactivated if every type was read to its end."""
    run = {"region": "26", "types": ["39", "12"], "stopped_by_budget": False}
    out = jobs.JOBS["tourapi_spots_sync"](_spot_tables(t), payloads.list_pages(t), payloads.spot_details(t), run, at(), page_rows=40)
    return out["spots"].select("content_id", "title", "is_active")


@query(f"""select cast(p_partkey as varchar) as content_id, case when p_partkey % 6 <> 0 then trim(p_type) end as overview from {{part}} where {_LISTED} and not ({_UNCHANGED})""")
def spots_sync_details(t) -> DataFrame:
    """MUT-2: details of the spots that were read."""
    run = {"region": "26", "types": ["39", "12"], "stopped_by_budget": True}
    out = jobs.JOBS["tourapi_spots_sync"](_spot_tables(t), payloads.list_pages(t), payloads.spot_details(t), run, at(), page_rows=40)
    return out["details"].select("content_id", "overview")


@query("select (select count(*) from {part} where p_partkey % 13 = 0) as skip_invalid_count, count(*) as fetched, 'stopped_by_budget' as deactivation_skip_reason from {part}")
def spots_sync_figures(t) -> DataFrame:
    """FLT-9 and the gate's reason."""
    run = {"region": "26", "types": ["39", "12"], "stopped_by_budget": True}
    out = jobs.JOBS["tourapi_spots_sync"](_spot_tables(t), payloads.list_pages(t), payloads.spot_details(t), run, at(), page_rows=40)
    return out["metrics"].select("skip_invalid_count", "fetched", "deactivation_skip_reason")


_COURSES = "(select o_orderkey from {orders} where o_orderkey % 9 <> 0 and o_orderkey in (select l_orderkey from {lineitem}))"


def _courses(t) -> jobs.Tables:
    old = t("orders").filter("o_orderkey % 5 = 0").select(_text("o_orderkey").alias("content_id"), F.lit("old").alias("title"), F.lit(1).alias("taketime_minutes"), F.lit(False).alias("is_active"))
    items = t("orders").filter("o_orderkey % 5 = 0").select(_text("o_orderkey").alias("course_content_id"), F.lit(1).alias("serial_num"), F.lit("old").alias("sub_content_id"), F.lit(None).cast("string").alias("matched_spot_id"))
    tables = {"courses": old, "course_items": items, "course_raw": _empty(t, "content_id string, raw_json string"), "spots": t("spots")}
    return jobs.JOBS["tourapi_courses_sync"](tables, payloads.course_details(t), at())


@query(f"select cast(o_orderkey as varchar) as content_id, case when o_orderkey not in {_COURSES} then 'old' when o_orderkey % 4 = 0 then 'course-' || cast(o_orderkey as varchar) else 'c' || cast(o_orderkey as varchar) end as title, o_orderkey in {_COURSES} as is_active from {{orders}} where o_orderkey in {_COURSES} or o_orderkey % 5 = 0")
def courses_sync(t) -> DataFrame:
    """JOB tourapi_courses_sync, MUT-6: courses inserted, overwritten and active again."""
    return _courses(t)["courses"].select("content_id", "title", "is_active")


@query(f"""select cast(l_orderkey as varchar) as course_content_id, count(*) as items, count(s.content_id) as matched from {{lineitem}} l left join {{spots}} s on s.content_id = cast(l_partkey as varchar) where l_orderkey in {_COURSES} group by 1
    union all select cast(o_orderkey as varchar), 1, 0 from {{orders}} where o_orderkey % 5 = 0 and o_orderkey not in {_COURSES}""")
def courses_sync_items(t) -> DataFrame:
    """MUT-7 and JN-8: items of the courses read are replaced, spots that do not exist null."""
    items = _courses(t)["course_items"]
    return items.groupBy("course_content_id").agg(F.count("*").alias("items"), F.count("matched_spot_id").alias("matched"))


_FORECAST = "content_id string, area_cd string, signgu_cd string, raw_tats_name string, base_ymd date, rate double, level int, source string"


def _event_spots(t) -> DataFrame:
    """A spot for every second user and kind of event."""
    users = t("events").select("user_id", "event_type").distinct().filter("user_id % 2 = 0")
    return users.select(F.concat("event_type", F.lit("-"), _text("user_id")).alias("content_id"), F.concat("event_type", F.lit(" ("), _text("user_id"), F.lit(") "), _text("user_id")).alias("title"), _text(110 + F.col("user_id") % 16).alias("l_dong_signgu_cd"), F.lit(True).alias("is_active"))


_SEEN = payloads._FORECASTS.replace("event_id % 101 < 80 then 4 else 5 end as level", "event_id % 101 < 80 then 4 else 5 end as level, user_id, event_type")


@query(f"""with f as (select *, row_number() over (partition by user_id, event_type order by event_id) as o from {_SEEN})
    select case when user_id % 2 = 0 then event_type || '-' || cast(user_id as varchar) end as content_id, raw_tats_name, base_ymd, rate from (select *, row_number() over (partition by user_id, event_type, base_ymd order by event_id desc) as n from f) where n = 1""")
def congestion_sync(t) -> DataFrame:
    """JOB tourapi_congestion_sync, MUT-17, JN-6: forecasts matched by district and name, the last of a day kept."""
    out = jobs.JOBS["tourapi_congestion_sync"]({"forecast": _empty(t, _FORECAST), "spots": _event_spots(t)}, payloads.forecast_pages(t))
    return out["forecast"].select("content_id", "raw_tats_name", "base_ymd", "rate")


@query(f"select count(*) as fetched, count(*) filter (where user_id % 2 = 1) as unmatched, round(count(*) filter (where user_id % 2 = 0) / count(*), 6) as match_rate from {_SEEN}")
def congestion_sync_figures(t) -> DataFrame:
    """AGG-6 of the job."""
    out = jobs.JOBS["tourapi_congestion_sync"]({"forecast": _empty(t, _FORECAST), "spots": _event_spots(t)}, payloads.forecast_pages(t))
    return out["metrics"].select("fetched", "unmatched", F.round("match_rate", 6).alias("match_rate"))


@query("""select s.content_id, case when r.rate is null then cast(s.p_size as double) else r.rate end as today from {spots} s left join
    (select content_id, rate from (select *, row_number() over (partition by content_id order by ordinal desc) as n from {forecast} where content_id is not null and base_ymd = date '2024-01-15') where n = 1) r on r.content_id = s.content_id and s.is_active""")
def cache_refresh(t) -> DataFrame:
    """JOB today_concentration_cache_refresh behind its gate, MUT-16."""
    spots = t("spots").withColumns({"today_concentration_rate": F.col("p_size").cast("double"), "upcoming_avg_rate": F.lit(None).cast("decimal(5,2)"), "congestion_updated_at": F.lit(None).cast("timestamp")})
    forecast = mutations.last_write(t("forecast").filter("content_id is not null"), ["content_id", "base_ymd"], ["ordinal"])
    last = t("run_log").agg(F.max("id").alias("run_id")).select("run_id", F.lit(True).alias("complete"), F.lit(False).alias("stopped_by_budget"), *[F.lit(v).alias(n) for n, v in (("fetched", 10), ("upserted", 10), ("failed", 0), ("unmatched", 1))])
    out = jobs.JOBS["today_concentration_cache_refresh"]({"spots": spots, "forecast": forecast}, last, F.lit("2024-01-15").cast("date"), at())
    return out["spots"].select("content_id", F.col("today_concentration_rate").alias("today"))


@query("select count(*) filter (where base_ymd >= date '2024-01-15' - interval 7 day) as upserted, count(*) filter (where base_ymd < date '2024-01-15' - interval 7 day) as purged_count from {forecast}")
def congestion_purge(t) -> DataFrame:
    """JOB congestion_old_purge."""
    return jobs.JOBS["congestion_old_purge"]({"forecast": t("forecast")}, F.lit("2024-01-15").cast("date"))["metrics"].select("upserted", "purged_count")


@query("""with c as (select code1, code2, code3, coalesce(arg_min(name, p_partkey) filter (where name <> 'pending_sync'), 'pending_sync') as name from %s group by 1, 2, 3)
    select code1, code2, code3, case when code3 = '7' then 'known' else name end as name from c""" % payloads._CODES)
def classification_backfill(t) -> DataFrame:
    """JOB classification backfill, AGG-7, MUT-19."""
    known = normalize.classification_codes(payloads.code_pages(t)).filter("code3 = '7'").select("code1", "code2", "code3", F.lit("known").alias("name")).distinct()
    return jobs.JOBS["classification_backfill"]({"codes": known}, payloads.code_pages(t))["codes"]


def _menu_stores(t) -> jobs.Tables:
    named = t("named_places")
    return {"places": named.drop("source"), "sources": named.select(F.col("id").alias("food_place_id"), "source")}


@query("""with s as (select * from (select *, row_number() over (partition by name order by id desc) as n from {named_places} where source = 'good_price_store' and is_active and trim(address) <> '') where n = 1)
    select p.id, case when p.source = 'good_price_menu' and p.is_active and s.id is not null and (coalesce(trim(p.address), '') = '' or coalesce(trim(p.tel), '') = '' or coalesce(trim(p.source_region), '') = '' or p.map_x is null or p.map_y is null)
      and ((coalesce(trim(p.address), '') = '' and coalesce(s.address, '') <> '') or ((p.map_x is null or p.map_y is null) and s.map_x is not null and s.map_y is not null) or (coalesce(trim(p.tel), '') = '' and coalesce(s.tel, '') <> ''))
      then coalesce(nullif(trim(p.address), ''), s.address) else p.address end as address from {named_places} p left join s on s.name = p.name""")
def store_enrich(t) -> DataFrame:
    """JOB food_place_store_enrich, MUT-12."""
    return jobs.JOBS["food_place_store_enrich"](_menu_stores(t))["places"].select("id", "address")


@query("""select id, case when work and ok then cast('129.1' || cast(100 + id % 900 as varchar) as double) else map_x end as map_x from
    (select *, is_active and trim(address) <> '' and (map_x is null or map_y is null) as work, id % 5 <> 0 and id % 7 <> 0 as ok from {named_places})""")
def place_geocode(t) -> DataFrame:
    """JOB food_place_geocode, MUT-18."""
    places = t("named_places").withColumn("address", F.when(F.trim("address") != "", F.concat(F.lit("부산광역시 "), _text("id"))).otherwise(F.col("address")))
    asked = places.select(F.col("id").alias("c_custkey"), F.concat(F.lit("부산광역시 "), _text("id")).alias("query"))
    return jobs.JOBS["food_place_geocode"]({"places": places}, payloads.geocoder_answers(asked))["places"].select("id", "map_x")


_INFER = """with w as (select * from {named_places} where is_active and coalesce(trim(address), '') = '' and (map_x is null or map_y is null)) """


@query(_INFER + """select w.id, case when w.id % 3 = 0 then 'key' when w.id % 3 = 1 and w.id % 5 <> 0 and w.id % 7 <> 0 and w.id % 10 <> 3 then 'model' else 'open' end as found from w""")
def address_inference(t) -> DataFrame:
    """JOB food_place_address_inference, WIN-8, FLT-13, FLT-14: by keyword, else by a model's answer that the geocoder confirms."""
    places = t("named_places").withColumn("representative_menu", F.lit(None).cast("string"))
    targets = normalize.work_list(places, "location")
    document = lambda x: F.to_json(F.struct(F.array(F.struct(F.col("name").alias("place_name"), F.lit("부산 key").alias("road_address_name"), F.lit(x).alias("x"), F.lit("35.1").alias("y"))).alias("documents")))
    # of equal names one response serves all, so the places are told apart by their number
    unique = targets.withColumn("name", F.concat("name", F.lit(" no "), _text("id")))
    tables = {"places": places.join(unique.select("id", F.col("name").alias("_new")), "id", "left").withColumn("name", F.coalesce("_new", "name")).drop("_new"), "menus": t("menus")}
    keyword = unique.filter("id % 3 = 0").select(F.concat(F.lit("부산 "), "name").alias("query"), document("129.2").alias("payload"))
    address = F.concat(F.lit("부산광역시 "), _text("id"))
    answers = unique.filter("id % 3 = 1").select("id", F.to_json(F.struct(address.alias("address"), F.lit(0.9).alias("confidence"), F.lit("r").alias("reason"))).alias("raw"))
    responses = payloads.geocoder_answers(unique.select(F.col("id").alias("c_custkey"), address.alias("query")))
    out = jobs.JOBS["food_place_address_inference"](tables, keyword, answers, responses, similarity_udf(places.sparkSession))
    after = out["places"].join(targets.select("id"), "id", "left_semi")
    return after.select("id", F.when(F.col("address") == "부산 key", "key").when(F.col("address").startswith("부산광역시"), "model").otherwise("open").alias("found"))


@query("""with s as (select x.spot_content_id, min(m.price) as min_price, cast(count(*) as int) as menu_count from {menus} m join {matches} x on x.food_place_id = m.food_place_id where x.match_status = 'matched' and m.price > 0 group by 1)
    select spot_content_id, min_price, menu_count from s""")
def price_summary_refresh(t) -> DataFrame:
    """JOB spot_price_summary_refresh, MUT-14 and MUT-15: spots that have no prices any more are pruned."""
    old = t("nation").select(F.concat(F.lit("gone "), _text("n_nationkey")).alias("spot_content_id"), *[F.lit(0).alias(c) for c in ("min_price", "avg_price", "representative_price", "menu_count", "food_place_count")], F.lit("m").alias("representative_menu_name"))
    out = jobs.JOBS["spot_price_summary_refresh"]({"menus": t("menus"), "matches": t("matches"), "summary": old}, prune=True)
    return out["summary"].select("spot_content_id", "min_price", "menu_count")


def _landed_files(df: DataFrame, name: str) -> str:
    """df as header CSV files with quoted line breaks in the shared folder; returns the folder."""
    folder = f"{shared_dir(df.sparkSession)}/harborlight/{df.sparkSession.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    plain = {"header": True, "escape": '"', "quote": '"', "escapeQuotes": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": "", "nullValue": ""}
    df.write.options(**plain).csv(folder)
    return folder


@query("select page_id, url, sha256('\"' || html || '\",' || page_id || chr(10) || 'end') as text_sha256, true as numbered from {pages}")
def csv_rows(t) -> DataFrame:
    """SRC-9: texts with quotes, commas and line breaks, written as files and read back; each row was written with its number in its file."""
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 2  # of a partition, which is a file
    text = F.concat(F.lit('"'), "html", F.lit('",'), _text("page_id"), F.lit("\nend"))
    folder = _landed_files(t("pages").select("url", text.alias(" text"), _text("page_id").alias("page_id"), _text(number).alias("number")), "csv-pages")
    row = headers.as_row()
    rows = csv_records.read_csv_rows(t("region").sparkSession, folder)
    return rows.select(row["page_id"].cast("long").alias("page_id"), row["url"].alias("url"), F.sha2(row[" text"], 256).alias("text_sha256"), (row["number"].cast("long") == F.col("row_number")).alias("numbered"))


def _wide_menus() -> dict[str, Column]:
    """Headers of a file row: quoted names and menus, a menu in slots 1 and 12, and now and then a blank name or a blocked category."""
    name = F.when(_key() % 31 == 0, " ").otherwise(F.concat(F.lit('shop "'), "p_name", F.lit('", no.\n'), _text(_key())))
    return {"업소명": name, "업종": F.when(_key() % 9 == 0, "숙박업").otherwise("한식"), "연번": _text(_key()), "품목1": F.concat("p_type", F.lit(', "hot"')), " 가격1 ": F.lit("7,000원"), "메뉴_12": F.col("p_brand"), "가격12": _text(F.col("p_size") * 100)}


_FILE_MENUS = """with f as (select p_partkey, 'shop "' || p_name || '", no.' || chr(10) || p_partkey as name, p_type || ', "hot"' as first, p_brand, p_size from {part} where p_partkey % 31 <> 0 and p_partkey % 9 <> 0)
    select name, first as menu_name, 7000 as price, 1 as display_order, true as is_representative from f union all select name, p_brand, p_size * 100, 12, false from f"""


def _menus_by_name(out: jobs.Tables) -> DataFrame:
    names = out["places"].select(F.col("id").alias("food_place_id"), "name")
    return out["menus"].join(names, "food_place_id").select("name", "menu_name", "price", "display_order", "is_representative")


def _file_import(t) -> jobs.Tables:
    rows = t("part").select(*[value.alias(h) for h, value in _wide_menus().items()])
    return jobs.JOBS["good_price_file_import"](food_tables(t), csv_records.read_csv_rows(t("region").sparkSession, _landed_files(rows, "csv-shops")), at())


@query(_FILE_MENUS)
def file_import(t) -> DataFrame:
    """JOB good_price_file_import: wide menus of CSV files whose names hold quotes, commas and line breaks."""
    return _menus_by_name(_file_import(t))


@query("select count(*) as fetched, count(*) filter (where p_partkey % 31 <> 0 and p_partkey % 9 <> 0) as upserted, count(*) filter (where p_partkey % 31 = 0) as failed, count(*) filter (where p_partkey % 31 <> 0 and p_partkey % 9 = 0) as skipped_keyword_count from {part}")
def file_import_figures(t) -> DataFrame:
    """Counters of a CSV import, taken in the pass that writes the parse."""
    return _file_import(t)["metrics"]


@query(_FILE_MENUS)
def odcloud_sync(t) -> DataFrame:
    """JOB good_price_odcloud_sync: the same rows as pages of a file service."""
    row = F.struct(*[value.alias(h) for h, value in _wide_menus().items()])
    pages = t("part").groupBy(F.floor(_key() / 100).alias("page")).agg(F.collect_list(row).alias("rows"))  # at most 100 a page
    landed = pages.select("page", F.to_json(F.struct(F.col("rows").alias("data"))).alias("payload"), at().alias("fetched_at"))
    return _menus_by_name(jobs.JOBS["good_price_odcloud_sync"](food_tables(t), landed))


@query("select c_custkey, case when c_custkey % 3 = 0 then c_name || ' again' else c_name end as name, case when c_custkey % 3 = 0 and c_custkey % 2 = 1 then 'x' else c_mktsegment end as phone from {customer} where c_custkey % 7 <> 0 or c_custkey % 3 = 0")
def incremental_landing(t) -> DataFrame:
    """STR-1: payloads that land one after the other, worked off by a stream into a snapshot in buckets; repeated keys keep what is not null."""
    spark = t("region").sparkSession
    home = f"{shared_dir(spark)}/harborlight/landing-{uuid.uuid4().hex}"
    rows = t("customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("phone"))
    again = rows.filter("c_custkey % 3 = 0").select("c_custkey", F.concat("name", F.lit(" again")).alias("name"), F.when(F.col("c_custkey") % 2 == 1, "x").when(F.col("c_custkey") % 7 == 0, F.col("phone")).alias("phone"))
    for number, landed in enumerate((rows.filter("c_custkey % 7 <> 0"), again)):
        landed.write.parquet(f"{home}/in/{number}")
        stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{home}/in")
        run_incremental(stream, f"{home}/store", "customers", ["c_custkey"], f"{home}/checkpoint", policy={"phone": "keep_non_null"}).awaitTermination()
    return files.current(spark, f"{home}/store", "customers")


@query("select o_orderkey as content_id, o_orderstatus as source from {orders} where o_orderstatus = 'F'")
def one_source_only(t) -> DataFrame:
    """FLT-11: rows of one source pass; a job whose rows hold another one fails whole."""
    rows = t("orders").select(F.col("o_orderkey").alias("content_id"), F.col("o_orderstatus").alias("source"))
    return mutations.require_source(rows.filter("source = 'F'"), "source", "F")
