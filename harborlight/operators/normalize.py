"""Typed rows from source rows and payloads: spots, courses, food places, forecasts and classification codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlight.functions import text as tx
from harborlight.functions.spatial import point
from harborlight.operators import headers as hd
from harborlight.operators.generators import number_course_items, once, spot_images, with_menus
from harborlight.sources import envelopes as env

#: source of the place, source of its menus, kind of source: of each flavour of food rows.
FLAVOURS = {
    "store": ("good_price_store", "admin_manual", "api"),
    "shop": ("good_price_store", "admin_manual", "api"),
    "menu": ("good_price_menu", "good_price_menu", "api"),
    "file": ("good_price_file", "good_price_file", "file_import"),
    "guide": ("busan_food", "admin_manual", "api"),
}
#: What tells which of two rows of one place came later.
PLACE_ORDER = ["fetched_at", "page", "ordinal"]
# Headers of each field, and names of payload fields, in order.
HEADERS = {
    "name": ("업소명", "업소", "상호", "상호명", "bsshNm", "sj", "SJ", "MAIN_TITLE", "PLACE", "name", "shopName", "bsnsNm"),
    "address": ("주소", "주소(도로명 새주소)", "도로명주소", "소재지주소", "사업장 주소", "adres", "ADDR", "ADDR1", "addr", "address"),
    "addr2": ("ADDR2", "주소 기타", "상세주소"),
    "tel": ("연락처", "전화번호", "tel", "TEL", "CNTCT_TEL", "phone", "전화"),
    "category": ("업종", "업소구분", "cn", "category", "business_category"),
    "region": ("시군", "구군", "구군명", "GUGUN_NM", "지역", "locale", "source_region", "signguNm"),
    "representative": ("대표메뉴", "주메뉴", "대표품목", "RPRSNTV_MENU", "mainMenu"),
    "description": ("소개", "상세내용", "설명", "intrcn", "ITEMCNTNTS", "description"),
    "external_id": ("idx", "IDX", "UC_SEQ", "id", "ID", "external_id", "shopId"),
    "hours": ("영업시간", "운영시간", "운영 및 시간", "USAGE_DAY_WEEK_AND_TIME", "bsnTime", "business_hours"),
    "delivery": ("배달", "배달가능", "배달가능여부", "delivery_available"),
    "parking": ("주차", "주차가능", "주차가능여부", "parkngAt", "parking"),
    "map_x": ("경도", "LNG", "mapx", "map_x", "lon", "lng", "longitude"),
    "map_y": ("위도", "LAT", "mapy", "map_y", "lat", "latitude"),
    "menu_store": ("bsshNm", "업소명", "sj", "SJ"),
}
PARKING = ("parking", "parkinglodging", "parkingfood", "parkingculture", "parkingleports", "parkingshopping")
NO_NAME = "pending_sync"
TRIPLES = (("lclsSystm1", "lclsSystm2", "lclsSystm3"), ("lclsSystm1Cd", "lclsSystm2Cd", "lclsSystm3Cd"), ("code1", "code2", "code3"))
NAMES = ("lclsSystm3Nm", "lclsSystmNm3", "lclsSystm2Nm", "lclsSystm1Nm", "lclsSystmNm", "name", "codeNm", "lclsSystmNm1")
PARTS = ("lclsSystm1Nm", "lclsSystm2Nm", "lclsSystm3Nm", "lclsSystmNm1", "lclsSystmNm2", "lclsSystmNm3")


def food_rows(rows: DataFrame, flavour: str) -> DataFrame:
    """Every source row, with headers and cells or `row` (map of header to text), and fetched_at, as a place with menus, _blocked and _label (PRJ-27, PRJ-28).

    `page` and `ordinal` (of a page of items, or file and row number) say where a row stood; without them both are 0. Rows without a name are
    rejects (FLT-10) with that label, blocked ones hold words of FLT-1.
    """
    place_source, menu_source, kind = FLAVOURS[flavour]
    for n in PLACE_ORDER[1:]:
        if n not in rows.columns:
            rows = rows.withColumn(n, F.lit(0))
    base = with_menus(hd.resolved(hd.as_cells(rows), HEADERS))
    values = once(once(base, "_values", F.transform("_places", lambda p: hd.first_filled(p))), "row", hd.as_row())
    fields = values.withColumns({f"_{f}": F.get("_values", F.lit(i)) for i, f in enumerate(HEADERS)})
    c = F.col
    address = F.when(c("_address").isNotNull() & c("_addr2").isNotNull(), F.concat_ws(" ", "_address", "_addr2")).otherwise(c("_address"))
    tel = tx.squeeze(c("_tel"))
    own = tx.menu_store_id(c("_menu_store")) if flavour == "menu" else F.lit(None).cast("string")
    places = fields.select(
        F.lit(place_source).alias("source"),
        F.coalesce(own, c("_external_id"), tx.fallback_id(c("row"), c("_name"), address, tel)).alias("external_id"),
        c("_name").alias("name"),
        c("_category").alias("business_category"),
        tx.category_code(c("_category")).alias("normalized_category"),
        tx.is_food(c("_category")).alias("is_course_food_candidate"),
        address.alias("address"),
        tel.alias("tel"),
        c("_hours").alias("business_hours_raw"),
        c("_description").alias("description"),
        F.coalesce(c("_representative"), F.get("menus", F.lit(0))["menu_name"]).alias("representative_menu"),
        tx.yes_no(c("_delivery")).alias("delivery_available"),
        tx.yes_no(c("_parking")).alias("parking_available"),
        c("_region").alias("source_region"),
        tx.to_double(c("_map_x"), commas=True).alias("map_x"),
        tx.to_double(c("_map_y"), commas=True).alias("map_y"),
        F.lit(True).alias("is_active"),
        "menus",
        "row",
        F.lit(menu_source).alias("menu_source"),
        F.lit(kind).alias("source_type"),
        *PLACE_ORDER,
        F.when(c("_name").isNull(), tx.reject_label(c("row"))).alias("_label"),
    )
    return places.withColumn("_blocked", tx.blocked_place(c("name"), c("business_category"), c("representative_menu"), c("menus")))


def named_places(rows: DataFrame) -> DataFrame:
    """Of food_rows, the rows with a name."""
    return rows.filter("name is not null").drop("_label")


def nameless(rows: DataFrame) -> DataFrame:
    """Of food_rows, the rejects: label, error and where the row stood (FLT-10)."""
    return rows.filter("name is null").select(F.col("_label").alias("label"), F.lit("food place name is required").alias("error"), *PLACE_ORDER[1:])


def food_places(rows: DataFrame, flavour: str) -> tuple[DataFrame, DataFrame]:
    """(places with their menus, rejects) from source rows."""
    parsed = food_rows(rows, flavour)
    return named_places(parsed).drop("_blocked"), nameless(parsed)


def _text(v: Column, name: str) -> Column:
    return tx.blank_to_null(F.try_variant_get(v, f"$.{name}", "string"))


def _detail_rows(details: DataFrame) -> DataFrame:
    """Rows of combine_details with the variants common, intro, info, image, and content_id and _error from the first (PRJ-10, FLT-10)."""
    v = lambda e: F.try_parse_json(e)
    rows = details.withColumns({"common": env.first_item(v("detailCommon2")), "intro": env.first_item(v("detailIntro2")), "info": v("detailInfo2"), "image": v("detailImage2")})
    rows = rows.withColumn("content_id", _text(F.col("common"), "contentid"))
    times = [tx.impossible_time(_text(F.col("common"), k)) for k in ("modifiedtime", "createdtime")]
    error = F.when(F.col("content_id").isNull(), "content id is missing").when(times[0] | times[1], "time does not exist")
    return rows.withColumn("_error", error)


def _detail_rejects(rows: DataFrame) -> DataFrame:
    return rows.filter("_error is not null").select(F.substring(F.coalesce("detailCommon2", F.lit("")), 1, 120).alias("label"), F.col("_error").alias("error"))


def spots(details: DataFrame, synced_at: Column, fetched_at: Column) -> dict[str, DataFrame]:
    """core, detail, images, raw and rejects of spots (GEN-7, PRJ-22 to 25): one parse serves all. A missing id is a reject (FLT-10)."""
    rows = _detail_rows(details)
    good, c = rows.filter("_error is null"), F.col("common")
    parking = F.coalesce(*[_text(F.col("intro"), k) for k in PARKING])
    x, y = tx.to_double(_text(c, "mapx")), tx.to_double(_text(c, "mapy"))
    core = good.select("content_id", _text(c, "contenttypeid").alias("content_type_id"), _text(c, "title").alias("title"), x.alias("map_x"), y.alias("map_y"), point(x, y).alias("point"), _text(c, "lDongRegnCd").alias("l_dong_regn_cd"), _text(c, "lDongSignguCd").alias("l_dong_signgu_cd"), *[_text(c, f"lclsSystm{i}").alias(f"lcls_systm_{i}") for i in (1, 2, 3)], _text(c, "firstimage").alias("first_image"), _text(c, "firstimage2").alias("first_image2"), _text(c, "cpyrhtDivCd").alias("first_image_cpyrht_div_cd"), tx.kst_timestamp(_text(c, "modifiedtime")).alias("source_modified_time"), synced_at.alias("synced_at"), F.lit(True).alias("is_active"))
    detail = good.select("content_id", *[_text(c, k).alias(n) for k, n in (("tel", "tel"), ("telname", "tel_name"), ("homepage", "homepage"), ("addr1", "addr1"), ("addr2", "addr2"), ("zipcode", "zipcode"), ("overview", "overview"))], tx.text_hash(_text(c, "overview")).alias("overview_hash"), F.to_json("intro").alias("intro"), tx.yes_no(parking).alias("parking_available"), tx.kst_timestamp(_text(c, "createdtime")).alias("source_created_at"))
    raw = good.select("content_id", env.raw_snapshot({e: F.col(e) for e in env.DETAIL_ENDPOINTS}, fetched_at).alias("raw_json"), fetched_at.alias("fetched_at"))
    return {"core": core, "detail": detail, "images": spot_images(good), "raw": raw, "rejects": _detail_rejects(rows)}


def courses(details: DataFrame, synced_at: Column, fetched_at: Column) -> dict[str, DataFrame]:
    """course, items, raw and rejects of travel courses (GEN-8, PRJ-26)."""
    rows = _detail_rows(details)
    good, c = rows.filter("_error is null"), F.col("common")
    course = good.select("content_id", F.coalesce(_text(c, "title"), F.concat(F.lit("course-"), "content_id")).alias("title"), _text(c, "overview").alias("overview"), tx.text_hash(_text(c, "overview")).alias("overview_hash"), _text(c, "theme").alias("theme"), _text(c, "taketime").alias("taketime"), tx.digits_as_int(_text(c, "taketime")).alias("taketime_minutes"), tx.duration_minutes(_text(c, "taketime")).alias("duration_minutes"), _text(c, "distance").alias("distance"), tx.km(_text(c, "distance")).alias("distance_km"), _text(c, "schedule").alias("schedule"), _text(c, "infocentertourcourse").alias("infocenter_tourcourse"), _text(c, "firstimage").alias("first_image"), _text(c, "cpyrhtDivCd").alias("first_image_cpyrht_div_cd"), _text(c, "lDongRegnCd").alias("l_dong_regn_cd"), tx.kst_timestamp(_text(c, "modifiedtime")).alias("source_modified_time"), tx.kst_timestamp(_text(c, "createdtime")).alias("source_created_at"), synced_at.alias("synced_at"), F.lit(True).alias("is_active"))
    exploded = good.select(F.col("content_id").alias("course_content_id"), F.posexplode(env.course_items(F.col("info"))).alias("pos", "item"))
    i = F.col("item")
    listed = exploded.select("course_content_id", "pos", _text(i, "subnum").alias("subnum"), _text(i, "subcontentid").alias("sub_content_id"), _text(i, "subcontentid").alias("matched_spot_id"), _text(i, "subname").alias("sub_name"), _text(i, "subdetailoverview").alias("sub_overview"), _text(i, "subdetailimg").alias("sub_image"), _text(i, "subdetailalt").alias("sub_image_alt"))
    raw = good.select("content_id", env.raw_snapshot({e: F.col(e) for e in env.DETAIL_ENDPOINTS}, fetched_at).alias("raw_json"), fetched_at.alias("fetched_at"))
    return {"courses": course, "items": number_course_items(listed), "raw": raw, "rejects": _detail_rejects(rows)}


def forecasts(landed: DataFrame, source: str = "tourapi") -> tuple[DataFrame, DataFrame]:
    """(forecast rows, rejects) of landed congestion payloads with fetched_at (SRC-4, PRJ-21): a row without a required field is a reject."""
    i = F.col("item")
    area, code = _text(i, "areaCd"), _text(i, "signguCd")
    rate = tx.to_double(_text(i, "cnctrRate"))
    rows = env.list_items(landed).select("ordinal", "fetched_at", F.lit(None).cast("string").alias("content_id"), area.alias("area_cd"), tx.short_district(code, area).alias("signgu_cd"), _text(i, "tAtsNm").alias("raw_tats_name"), _text(i, "areaNm").alias("area_name"), _text(i, "signguNm").alias("signgu_name"), tx.ymd(_text(i, "baseYmd")).alias("base_ymd"), rate.alias("rate"), tx.congestion_level(rate).alias("level"), F.lit(source).alias("source"))
    whole = "area_cd is not null and signgu_cd is not null and raw_tats_name is not null and base_ymd is not null and rate is not null"
    return rows.filter(whole), rows.filter(f"not ({whole})").select(F.coalesce("raw_tats_name", F.lit("")).alias("label"), F.lit("required field missing").alias("error"))


def classification_codes(landed: DataFrame) -> DataFrame:
    """code1, code2, code3, name and ordinal of landed code pages with page (SRC-14, PRJ-34, PRJ-35)."""
    i = F.col("item")
    triple = F.coalesce(*[F.when(_text(i, a).isNotNull() & _text(i, b).isNotNull() & _text(i, c).isNotNull(), F.struct(_text(i, a).alias("code1"), _text(i, b).alias("code2"), _text(i, c).alias("code3"))) for a, b, c in TRIPLES])
    parts = F.nullif(F.concat_ws(" > ", *[_text(i, p) for p in PARTS]), F.lit(""))
    name = F.coalesce(*[_text(i, n) for n in NAMES], parts, F.lit(NO_NAME))
    return env.list_items(landed).select(triple.alias("t"), name.alias("name"), F.struct("page", "ordinal").alias("ordinal")).filter("t is not null").select("t.*", "name", "ordinal")


def listing(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(content_id, source_modified_time of listed items, last page first where an id comes twice; items without id) of landed list pages (PRJ-46, FLT-9)."""
    i = F.col("item")
    rows = env.list_items(pages).select("content_type_id", "page", "ordinal", env.item_id(i).alias("content_id"), tx.kst_timestamp(env.modified_text(i)).alias("source_modified_time"), F.to_json("item").alias("label"))
    # a listed time that does not exist counts as unknown: the item is listed, is read, and its details are the reject
    good = rows.filter("content_id is not null").groupBy("content_id").agg(F.max_by("source_modified_time", F.struct("page", "ordinal")).alias("source_modified_time"))
    return good, rows.filter("content_id is null").select(F.substring("label", 1, 120).alias("label"), F.lit("content id is missing").alias("error"))


def skip_unchanged(listing: DataFrame, stored: DataFrame) -> DataFrame:
    """Listed ids whose modified time differs from the stored one, or is unknown (FLT-5, SRC-12)."""
    old = stored.select("content_id", F.col("source_modified_time").alias("_old"))
    joined = listing.join(old, "content_id", "left")
    return joined.filter(~F.coalesce(F.col("source_modified_time") == F.col("_old"), F.lit(False))).drop("_old")


def overview_changed(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """content_id and whether the overview's hash differs from the stored one (SRC-13)."""
    old = stored.select("content_id", F.col("overview_hash").alias("_old"))
    return incoming.join(old, "content_id", "left").select("content_id", (~F.col("overview_hash").eqNullSafe(F.col("_old"))).alias("changed"))


def districts(codes: DataFrame, area: str) -> DataFrame:
    """District codes of an area in order (SRC-11)."""
    return codes.filter(F.col("regn_cd") == area).orderBy("signgu_cd")


def place_ids(places: DataFrame, sources: DataFrame) -> DataFrame:
    """food_place_id of each (source, external_id) of places: the known one, else a 63-bit hash of both (JN-9).

    Of keys whose hashes agree, with each other or with a known id, the later ones are hashed again with their number.
    """
    key = ["source", "external_id"]
    own = places.select(*key).distinct()
    known = sources.select(*key, F.col("food_place_id").alias("_known"))
    hashed = lambda *more: F.xxhash64(*key, *more).bitwiseAND(F.lit((1 << 63) - 1))
    fresh = own.join(known, key, "left_anti").select(*key, hashed().alias("_id"), F.lit(1).alias("_new"))
    none = F.lit(None).cast("string")
    taken = known.select(none.alias("source"), none.alias("external_id"), F.col("_known").alias("_id"), F.lit(0).alias("_new")).distinct()
    number = rank_in(["_id"], [F.col("_new"), *[F.col(k) for k in key]])
    given = fresh.unionByName(taken).withColumn("_n", number).filter("_new = 1")
    given = given.select(*key, F.when(F.col("_n") == 1, F.col("_id")).otherwise(hashed("_n")).alias("_known"))
    return known.join(own, key, "left_semi").unionByName(given).withColumnRenamed("_known", "food_place_id")


def assign_ids(places: DataFrame, sources: DataFrame) -> DataFrame:
    """places with the food_place_id of place_ids."""
    return places.join(place_ids(places, sources), ["source", "external_id"], "left")


def work_list(places: DataFrame, kind: str, limit: int | None = None) -> DataFrame:
    """Active places to locate: 'coordinates' (address known, FLT-2) or 'location' (neither known, FLT-3), by id (LIM-1)."""
    has = F.coalesce(F.trim("address"), F.lit("")) != ""
    rows = places.filter(F.col("is_active") & (has if kind == "coordinates" else ~has) & (F.col("map_x").isNull() | F.col("map_y").isNull()))
    ordered = rows.orderBy("id")
    return ordered if limit is None else ordered.limit(limit)


def rank_in(by: list[str], order: list[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order))
