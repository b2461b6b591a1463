"""Registered queries of readers, projections and small operators over payloads that are built from the tables of a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight.functions import text as tx
from harborlight.functions.spatial import in_box
from harborlight.operators import aggregates as agg
from harborlight.operators import generators as gen
from harborlight.operators import geocode, guards, headers, mutations, normalize, runlog
from harborlight.plans.catalog import query
from harborlight.sources import envelopes as env

AT = "2024-02-01 00:00:00"


def envelope(item: Column) -> Column:
    """A list response with one item, or with an array of them."""
    return F.to_json(F.struct(F.struct(F.struct(F.struct(item.alias("item")).alias("items")).alias("body")).alias("response")))


def at() -> Column:
    return F.lit(AT).cast("timestamp")


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _object(**fields: Column) -> Column:
    """A JSON object; null fields are left out."""
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def _key() -> Column:
    return F.col("p_partkey")


def _minute() -> Column:
    return F.lpad((_key() % 60).cast("string"), 2, "0")


def spot_details(t) -> DataFrame:
    """Landed detail payloads of parts as spots: (content_id, endpoint, payload)."""
    parking = F.when(_key() % 3 == 0, F.lit("가능")).when(_key() % 3 == 1, F.lit("불가능"))
    common = _object(
        contentid=F.when(_key() % 13 != 0, _text(_key())), contenttypeid=F.lit("39"), title=F.concat(F.lit(" "), "p_name"),
        mapx=F.when(_key() % 5 == 0, "x").otherwise(F.concat(F.lit("129."), _text(100 + _key() % 900))), mapy=F.when(_key() % 7 != 0, F.concat(F.lit("35."), _text(100 + _key() % 900))),
        lDongRegnCd=F.lit("26"), lDongSignguCd=_text(100 + _key() % 16), lclsSystm1=F.substring("p_brand", 1, 5), firstimage=F.when(_key() % 4 != 0, F.concat(F.lit("u"), _text(_key()))),
        modifiedtime=F.concat(F.lit("2024010209"), _minute(), F.when(_key() % 11 == 0, "").otherwise("00")), createdtime=F.concat(F.lit("2023010208"), _minute(), F.lit("59")),
        tel=F.when(_key() % 2 == 0, " ").otherwise("051"), addr1=F.col("p_type"), overview=F.when(_key() % 6 == 0, " \n").otherwise(F.concat(F.lit(" "), "p_type", F.lit("\n"))),
    )
    intro = _object(parkingfood=F.when(_key() % 2 == 0, parking), parkingleports=F.when(_key() % 2 == 1, parking), opentimefood=F.col("p_size").cast("string"))
    image = lambda i: _object(serialnum=F.when(_key() % 3 != 0, F.lit(f"s{i % 2}")), originimgurl=F.when((_key() + i) % 4 != 0, F.concat(F.lit("img"), _text(_key()), F.lit(f"-{i}"))), imgname=F.lit(f"n{i}"))
    bodies = {"detailCommon2": envelope(common), "detailIntro2": envelope(intro), "detailImage2": envelope(F.array(*[image(i) for i in range(3)])), "detailInfo2": F.lit("[broken")}
    rows = t("part").select(_text(_key()).alias("content_id"), F.array(*[F.struct(F.lit(e).alias("endpoint"), b.alias("payload")) for e, b in bodies.items()]).alias("all"))
    return rows.select("content_id", F.inline("all"))


def _spots(t) -> dict[str, DataFrame]:
    return normalize.spots(env.combine_details(spot_details(t)), at(), at())


_LISTED = "p_partkey % 13 <> 0"
_X = "case when p_partkey % 5 <> 0 then cast('129.' || cast(100 + p_partkey % 900 as varchar) as double) end"
_Y = "case when p_partkey % 7 <> 0 then cast('35.' || cast(100 + p_partkey % 900 as varchar) as double) end"


@query(f"""select cast(p_partkey as varchar) as content_id, '39' as content_type_id, p_name as title, {_X} as map_x, {_Y} as map_y, {_X} is not null and {_Y} is not null as located, cast(100 + p_partkey % 16 as varchar) as l_dong_signgu_cd,
    substr(p_brand, 1, 5) as lcls_systm_1, case when p_partkey % 4 <> 0 then 'u' || cast(p_partkey as varchar) end as first_image, case when p_partkey % 11 <> 0 then '2024-01-02 00:' || lpad(cast(p_partkey % 60 as varchar), 2, '0') || ':00' end as modified, true as is_active from {{part}} where {_LISTED}""")
def spot_core(t) -> DataFrame:
    """SRC-2, PRJ-2, PRJ-10, PRJ-24, PRJ-44, GEN-7."""
    core = _spots(t)["core"]
    return core.select("content_id", "content_type_id", "title", "map_x", "map_y", F.col("point").isNotNull().alias("located"), "l_dong_signgu_cd", "lcls_systm_1", "first_image", F.date_format("source_modified_time", "yyyy-MM-dd HH:mm:ss").alias("modified"), "is_active")


@query(f"""select cast(p_partkey as varchar) as content_id, case when p_partkey % 2 = 1 then '051' end as tel, p_type as addr1, case when p_partkey % 6 <> 0 then trim(p_type) end as overview, case when p_partkey % 6 <> 0 then sha256(trim(p_type)) end as overview_hash,
    case p_partkey % 3 when 0 then true when 1 then false end as parking_available, '2023-01-01 23:' || lpad(cast(p_partkey % 60 as varchar), 2, '0') || ':59' as created, cast(p_size as varchar) as open_time from {{part}} where {_LISTED}""")
def spot_detail(t) -> DataFrame:
    """PRJ-13, PRJ-23, PRJ-25."""
    detail = _spots(t)["detail"]
    return detail.select("content_id", "tel", "addr1", "overview", "overview_hash", "parking_available", F.date_format("source_created_at", "yyyy-MM-dd HH:mm:ss").alias("created"), F.get_json_object("intro", "$.opentimefood").alias("open_time"))


@query(f"""with i as (select p_partkey, unnest([0, 1, 2]) as i from {{part}} where {_LISTED}),
    g as (select *, 'img' || cast(p_partkey as varchar) || '-' || cast(i as varchar) as url, 's' || cast(i % 2 as varchar) as named, row_number() over (partition by p_partkey order by i) as n from i where (p_partkey + i) % 4 <> 0),
    s as (select *, case when p_partkey % 3 = 0 then cast(n as varchar) else named end as serial_num from g),
    one as (select *, row_number() over (partition by p_partkey, serial_num order by i) as k from s)
    select cast(p_partkey as varchar) as content_id, serial_num, url as origin_img_url, 'n' || cast(i as varchar) as img_name from one where k = 1""")
def spot_image_rows(t) -> DataFrame:
    """GEN-5: images without address left out, missing serials counted, repeated ones dropped."""
    return _spots(t)["images"].select("content_id", "serial_num", "origin_img_url", "img_name")


@query("""select cast(p_partkey as varchar) as content_id, case when p_partkey % 13 <> 0 then p_name else 'old' end as title, case when p_partkey % 13 <> 0 then '2024-02-01T00:00:00Z' else 'old' end as fetched_at,
    case when p_partkey % 13 <> 0 then '{}' end as info from {part} where p_partkey % 13 <> 0 or p_partkey % 2 = 0""")
def spot_raw_documents(t) -> DataFrame:
    """PRJ-22 and MUT-3: the raw document of all endpoints replaces the stored one."""
    old = t("part").filter("p_partkey % 2 = 0").select(_text(_key()).alias("content_id"), F.lit('{"endpoints":{"detailCommon2":{"data":{"response":{"body":{"items":{"item":{"title":" old"}}}}},"fetched_at":"old"}}}').alias("raw_json"), at().alias("fetched_at"))
    raw = mutations.apply_upsert(old, _spots(t)["raw"], ["content_id"])
    get = lambda path: F.get_json_object("raw_json", f"$.endpoints.{path}")
    return raw.select("content_id", F.trim(get("detailCommon2.data.response.body.items.item.title")).alias("title"), get("detailCommon2.fetched_at").alias("fetched_at"), get("detailInfo2.data").alias("info"))


@query("select count(*) as rejects, count(distinct error) as reasons from (select 'content id is missing' as error from {part} where p_partkey % 13 = 0)")
def spot_rejects(t) -> DataFrame:
    """FLT-10: payloads without an id."""
    return _spots(t)["rejects"].agg(F.count("*").alias("rejects"), F.count_distinct("error").alias("reasons"))


def course_details(t) -> DataFrame:
    """Landed course payloads of orders, their lines as sub-items."""
    key = F.col("o_orderkey")
    item = _object(subnum=F.when(F.col("l_linenumber") % 4 != 0, _text(9 - F.col("l_linenumber"))), subcontentid=_text("l_partkey"), subname=F.concat(F.lit("s"), _text("l_linenumber")))
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", item.alias("item")))).alias("lines"))
    several, one = envelope(F.transform("lines", lambda x: x["item"])), F.to_json(F.get("lines", F.lit(0))["item"])
    info = F.when(F.size("lines") == 1, one).otherwise(several)
    common = _object(contentid=F.when(key % 9 != 0, _text(key)), title=F.when(key % 4 == 0, " ").otherwise(F.concat(F.lit("c"), _text(key))), overview=F.col("o_orderpriority"), modifiedtime=F.lit("20240102090000"))
    intro = _object(distance=F.concat(_text(key % 50), F.lit(".5km")), taketime=F.concat(_text(key % 7), F.lit("시간 "), _text(key % 60), F.lit("분")))
    common = F.struct(*[common[n].alias(n) for n in ("contentid", "title", "overview", "modifiedtime")], intro["distance"].alias("distance"), intro["taketime"].alias("taketime"))
    rows = t("orders").join(lines, "o_orderkey").select(_text(key).alias("content_id"), F.array(F.struct(F.lit("detailCommon2").alias("endpoint"), envelope(common).alias("payload")), F.struct(F.lit("detailInfo2").alias("endpoint"), info.alias("payload"))).alias("all"))
    return rows.select("content_id", F.inline("all"))


def _courses(t) -> dict[str, DataFrame]:
    return normalize.courses(env.combine_details(course_details(t)), at(), at())


_COURSES = "(select * from {orders} where o_orderkey % 9 <> 0 and o_orderkey in (select l_orderkey from {lineitem}))"


@query(f"""select cast(o_orderkey as varchar) as content_id, case when o_orderkey % 4 = 0 then 'course-' || cast(o_orderkey as varchar) else 'c' || cast(o_orderkey as varchar) end as title, sha256(o_orderpriority) as overview_hash,
    cast(cast(o_orderkey % 7 as varchar) || cast(o_orderkey % 60 as varchar) as int) as taketime_minutes, cast(o_orderkey % 7 * 60 + o_orderkey % 60 as int) as duration_minutes, cast(cast(o_orderkey % 50 as varchar) || '.5' as decimal(7,3)) as distance_km from {_COURSES}""")
def course_rows(t) -> DataFrame:
    """PRJ-16, PRJ-17, PRJ-26, GEN-8."""
    return _courses(t)["courses"].select("content_id", "title", "overview_hash", "taketime_minutes", "duration_minutes", "distance_km")


@query(f"""with l as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as pos from {{lineitem}} where l_orderkey in (select o_orderkey from {_COURSES}))
    select cast(l_orderkey as varchar) as course_content_id, row_number() over (partition by l_orderkey order by l_linenumber % 4 = 0, 9 - l_linenumber * case when l_linenumber % 4 = 0 then 0 else 1 end, pos) as serial_num, cast(l_partkey as varchar) as sub_content_id, 's' || cast(l_linenumber as varchar) as sub_name from l""")
def course_item_rows(t) -> DataFrame:
    """SRC-5, GEN-6, WIN-10: a list of sub-items, or a payload that is one itself."""
    return _courses(t)["items"].select("course_content_id", F.col("serial_num").cast("long").alias("serial_num"), "sub_content_id", "sub_name")


def forecast_pages(t) -> DataFrame:
    """Landed congestion payloads, one for each user and type of event."""
    day, e = F.date_format("ts", "yyyyMMdd"), F.col("event_id")
    item = _object(areaCd=F.lit("26"), signguCd=F.when(e % 3 == 0, _text(110 + F.col("user_id") % 16)).otherwise(F.concat(F.lit("26"), _text(110 + F.col("user_id") % 16))), tAtsNm=F.when(e % 17 != 0, F.concat("event_type", F.lit(" "), _text("user_id"))), baseYmd=F.when(e % 19 == 0, F.lit("2024-01")).otherwise(day), cnctrRate=F.when(e % 23 == 0, "x").otherwise(_text(e % 101)))
    rows = t("events").groupBy("user_id", "event_type").agg(F.array_sort(F.collect_list(F.struct("event_id", item.alias("item")))).alias("rows"))
    return rows.select(envelope(F.transform("rows", lambda r: r["item"])).alias("payload"), at().alias("fetched_at"))


_FORECASTS = """(select event_id, cast(110 + user_id % 16 as varchar) as signgu_cd, event_type || ' ' || cast(user_id as varchar) as raw_tats_name, cast(ts as date) as base_ymd, cast(event_id % 101 as double) as rate,
    case when event_id % 101 < 20 then 1 when event_id % 101 < 40 then 2 when event_id % 101 < 60 then 3 when event_id % 101 < 80 then 4 else 5 end as level from {events} where event_id % 17 <> 0 and event_id % 19 <> 0 and event_id % 23 <> 0)"""


@query(f"select signgu_cd, raw_tats_name, base_ymd, rate, level, count(*) as n from {_FORECASTS} group by all")
def forecast_rows(t) -> DataFrame:
    """SRC-4, PRJ-11, PRJ-18, PRJ-19, PRJ-21."""
    rows, _ = normalize.forecasts(forecast_pages(t))
    return rows.groupBy("signgu_cd", "raw_tats_name", "base_ymd", "rate", "level").agg(F.count("*").alias("n"))


@query("select count(*) as rejects from {events} where event_id % 17 = 0 or event_id % 19 = 0 or event_id % 23 = 0")
def forecast_rejects(t) -> DataFrame:
    """PRJ-21: rows without a required field."""
    return normalize.forecasts(forecast_pages(t))[1].agg(F.count("*").alias("rejects"))


def code_pages(t) -> DataFrame:
    """Landed classification pages: triples under three spellings, names under several."""
    key = F.col("p_partkey")
    first, second, third = F.substring("p_brand", 1, 7), F.substring("p_type", 1, 5), F.when(key % 10 != 0, _text("p_size"))
    under = lambda i, *names: {n: F.when(key % 3 == i, v) for n, v in zip(names, (first, second, third), strict=True)}
    item = _object(**under(0, "lclsSystm1", "lclsSystm2", "lclsSystm3"), **under(1, "lclsSystm1Cd", "lclsSystm2Cd", "lclsSystm3Cd"), **under(2, "code1", "code2", "code3"), lclsSystm3Nm=F.when(key % 5 == 0, F.col("p_name")), lclsSystm1Nm=F.when(key % 5 == 1, F.concat(F.lit("one "), "p_name")), codeNm=F.when(key % 5 == 2, F.concat(F.lit("code "), "p_name")))
    rows = t("part").groupBy(F.floor(key / 50).cast("int").alias("page")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("item")))).alias("rows"))
    return rows.select("page", envelope(F.transform("rows", lambda r: r["item"])).alias("payload"))


_CODES = """(select substr(p_brand, 1, 7) as code1, substr(p_type, 1, 5) as code2, cast(p_size as varchar) as code3, case p_partkey % 5 when 0 then p_name when 1 then 'one ' || p_name when 2 then 'code ' || p_name else 'pending_sync' end as name, p_partkey from {part} where p_partkey % 10 <> 0)"""


@query(f"select code1, code2, code3, name, count(*) as n from {_CODES} group by all")
def classification_rows(t) -> DataFrame:
    """SRC-14, PRJ-34, PRJ-35."""
    return normalize.classification_codes(code_pages(t)).groupBy("code1", "code2", "code3", "name").agg(F.count("*").alias("n"))


def list_pages(t, types: tuple[str, ...] = ("39", "12"), page_rows: int = 40) -> DataFrame:
    """Landed list pages of parts: ids as texts or numbers, some missing. The last page of a type is short."""
    key = F.col("p_partkey")
    item = F.to_json(_object(contentid=F.when(key % 13 != 0, _text(key)), modifiedtime=F.concat(F.lit("20240102090"), _text(key % 10), F.lit("00")), title=F.col("p_name")))
    item = F.when(key % 2 == 0, F.regexp_replace(item, '"contentid":"([0-9]+)"', '"contentid":$1')).otherwise(item)
    kind = F.when(key % 2 == 0, types[0]).otherwise(types[1])
    rows = t("part").groupBy(kind.alias("content_type_id"), F.floor(key / (2 * page_rows)).cast("int").alias("page")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("item")))).alias("rows"))
    body = F.concat(F.lit('{"response":{"body":{"items":{"item":['), F.array_join(F.transform("rows", lambda r: r["item"]), ","), F.lit("]}}}}"))
    return rows.select("content_type_id", "page", body.alias("payload"))


@query("select cast(p_partkey as varchar) as content_id, '2024-01-02 00:0' || cast(p_partkey % 10 as varchar) as modified from {part} where p_partkey % 13 <> 0")
def listed_items(t) -> DataFrame:
    """PRJ-46."""
    return normalize.listing(list_pages(t))[0].select("content_id", F.date_format("source_modified_time", "yyyy-MM-dd HH:mm").alias("modified"))


@query("""select (select count(*) from {part} where p_partkey % 13 = 0) as invalid, (select count(*) from {part}) as items, count(*) = 2 and bool_and(short) as complete, false as with_unread
    from (select p_partkey % 2, bool_or(n < 40) as short from (select p_partkey % 2, floor(p_partkey / 80), count(*) as n from {part} group by 1, 2) as pages(p_partkey, page, n) group by 1) as kinds(kind, short)""")
def listing_figures(t) -> DataFrame:
    """FLT-9 and GRD-3: items without id counted; complete if every type reached a short page, not if one was never read."""
    pages = list_pages(t)
    sized = env.page_sizes(pages).select("content_type_id", "page", "items")
    invalid = normalize.listing(pages)[1].agg(F.count("*").alias("n")).select(F.lit("invalid").alias("k"), "n")
    items = sized.agg(F.sum("items").alias("n")).select(F.lit("items").alias("k"), "n")
    flags = [guards.listing_complete(sized, types, 40).select(F.lit(k).alias("k"), F.col("complete").cast("long").alias("n")) for k, types in (("complete", ["39", "12"]), ("with_unread", ["39", "12", "28"]))]
    found = invalid.unionByName(items).unionByName(flags[0]).unionByName(flags[1])
    one = lambda k: F.max(F.when(F.col("k") == k, F.col("n")))
    return found.agg(one("invalid").alias("invalid"), one("items").alias("items"), (one("complete") == 1).alias("complete"), (one("with_unread") == 1).alias("with_unread"))


def geocoder_answers(customers: DataFrame) -> DataFrame:
    """Landed address responses for `query`: a document, one without y, or none."""
    key = F.col("c_custkey")
    x, y = F.concat(F.lit("129.1"), _text(100 + key % 900)), F.concat(F.when(key % 10 == 3, "37.1").otherwise("35.1"), _text(100 + key % 900))
    document = F.to_json(_object(documents=F.array(_object(x=x, y=F.when(key % 5 != 0, y)))))
    return customers.select("query", F.when(key % 7 == 0, '{"documents":[]}').otherwise(document).alias("payload"))


@query("""select c_custkey as id, case when ok then cast('129.1' || cast(100 + c_custkey % 900 as varchar) as double) end as map_x, case when ok then 'resolved' else 'failed' end as outcome
    from (select *, c_custkey % 5 <> 0 and c_custkey % 7 <> 0 and c_custkey % 11 <> 0 as ok from {customer})""")
def geocode_answers(t) -> DataFrame:
    """SRC-6: addresses resolved from landed responses; unanswered ones fail."""
    asked = t("customer").select("c_custkey", F.col("c_custkey").alias("id"), F.concat(F.lit("부산광역시 "), _text("c_custkey")).alias("query"))
    found = geocode.resolve_addresses(asked.select("id", "query"), geocoder_answers(asked.filter("c_custkey % 11 <> 0")))
    return found.select("id", "map_x", "outcome")


@query("""select c_custkey, k as ordinal, c_name || case k when 0 then ' a' else ' b' end as place_name, case when (c_custkey + k) % 3 = 0 then 'road ' || cast(c_custkey as varchar) when (c_custkey + k) % 3 = 1 then 'lot' end as address,
    case when (c_custkey + k) % 4 = 0 then null else 129.5 end as x from (select *, unnest([0, 1]) as k from {customer})""")
def keyword_document_rows(t) -> DataFrame:
    """PRJ-40: road address, else lot address."""
    key = F.col("c_custkey")
    doc = lambda k: _object(place_name=F.concat("c_name", F.lit((" a", " b")[k])), road_address_name=F.when((key + k) % 3 == 0, F.concat(F.lit("road "), _text(key))).otherwise(" "), address_name=F.when((key + k) % 3 != 2, F.lit("lot")), x=F.when((key + k) % 4 == 0, "x").otherwise("129.5"), y=F.lit("35.1"))
    landed = t("customer").select("c_custkey", F.to_json(_object(documents=F.array(doc(0), doc(1)))).alias("payload"))
    return env.keyword_documents(landed).select("c_custkey", F.col("ordinal").cast("int").alias("ordinal"), "place_name", "address", "x")


def model_answers(t) -> DataFrame:
    """Answers of the address model: confident or not, outside the city, with unknown fields, or broken."""
    key = F.col("c_custkey")
    address = F.concat(F.when(key % 8 == 1, "서울 ").otherwise("부산광역시 "), _text(key))
    good = F.to_json(_object(address=address, confidence=(key % 100).cast("double") / 100, reason=F.lit(" r ")))
    raw = F.when(key % 8 == 2, "{broken").when(key % 8 == 3, F.to_json(_object(address=address, confidence=F.lit(0.9), reason=F.lit(""), other=F.lit(1)))).when(key % 8 == 4, F.to_json(_object(address=address, confidence=F.lit(1.5), reason=F.lit("")))).otherwise(good)
    return t("customer").select("c_custkey", key.alias("id"), raw.alias("raw"), F.concat(F.lit("부산광역시 "), F.when(key % 8 == 1, F.concat(F.lit("서울 "), _text(key))).otherwise(_text(key))).alias("query"))


_ANSWER = """case when c_custkey % 100 < 75 then 'low_confidence' when c_custkey % 8 = 1 then 'outside' when c_custkey % 5 = 0 or c_custkey % 7 = 0 or c_custkey % 11 = 0 then 'failed' when c_custkey % 10 = 3 then 'outside' else 'resolved' end"""


@query(f"select c_custkey as id, (case when c_custkey % 8 = 1 then '서울 ' else '부산광역시 ' end) || cast(c_custkey as varchar) as address, {_ANSWER} as outcome from {{customer}} where c_custkey % 8 not in (2, 3, 4)")
def inference_outcomes(t) -> DataFrame:
    """PRJ-42 and FLT-13."""
    answers = model_answers(t)
    responses = geocoder_answers(answers.filter("c_custkey % 11 <> 0 and c_custkey % 8 <> 1"))
    return geocode.accept_inferences(geocode.parse_inferences(answers.select("id", "raw")), responses).select("id", "address", "outcome")


@query("select outcome, count(*) as n from (select case when c_custkey % 5 <> 0 and c_custkey % 7 <> 0 and c_custkey % 11 <> 0 then 'resolved' else 'failed' end as outcome from {customer}) group by 1")
def geocode_counters(t) -> DataFrame:
    """AGG-11."""
    counted = agg.outcome_counters(geocode_answers(t))
    return counted.select(F.inline(F.array(*[F.struct(F.lit(o).alias("outcome"), F.col(o).alias("n")) for o in ("resolved", "failed")])))


@query("select l_orderkey, l_linenumber, case when l_linenumber in (3, 4, 5) then null when l_linenumber = 6 then 1000.0 * (l_suppkey % 9 + 1) else cast(floor(l_extendedprice) as double) + 0.5 end as plain, case when l_linenumber = 3 then null else cast(floor(l_extendedprice) as double) * 1000 + 1 end as grouped from {lineitem}")
def number_texts(t) -> DataFrame:
    """PRJ-2 and PRJ-3, also the forms that only some languages read as numbers."""
    n, number = _text(F.floor("l_extendedprice")), F.col("l_linenumber")
    plain = F.when(number == 3, "1.2.3").when(number == 4, F.concat(n, F.lit("d"))).when(number == 5, F.concat(n, F.lit(".5f"))).when(number == 6, F.concat(_text(F.col("l_suppkey") % 9 + 1), F.lit("_000"))).otherwise(F.concat(F.lit(" "), n, F.lit(".5 ")))
    grouped = F.when(number == 3, "1,x").otherwise(F.concat(n, F.lit(",001")))
    return t("lineitem").select("l_orderkey", "l_linenumber", tx.to_double(plain).alias("plain"), tx.to_double(grouped, commas=True).alias("grouped"))


@query("select c_custkey, cast(110 + c_custkey % 16 as varchar) as short, '26' || cast(110 + c_custkey % 16 as varchar) as long from {customer}")
def district_codes(t) -> DataFrame:
    """PRJ-19 and PRJ-20."""
    code, area = _text(110 + F.col("c_custkey") % 16), F.lit("26")
    given = F.when(F.col("c_custkey") % 2 == 0, code).otherwise(F.concat(area, code))
    return t("customer").select("c_custkey", tx.short_district(given, area).alias("short"), tx.long_district(tx.short_district(given, area), area).alias("long"))


@query("select o_orderkey, strftime(o_orderdate + to_seconds(o_orderkey % 86400) - interval 9 hour, '%Y-%m-%d %H:%M:%S') as utc from {orders}")
def utc_instants(t) -> DataFrame:
    """PRJ-12."""
    local = F.expr("timestampadd(second, cast(o_orderkey % 86400 as int), o_orderdate)")
    return t("orders").select("o_orderkey", F.date_format(tx.local_to_utc(local), "yyyy-MM-dd HH:mm:ss").alias("utc"))


_ITEMS = """'[{"key":"a","value":"' || c_name || '"},{"key":"b","value":"' || cast(c_custkey as varchar) || '"}]'"""


@query("select c_custkey, substr(sha256(c_name || '||' || case when c_custkey % 2 = 0 then '051' else '' end || '|' || " + _ITEMS + "), 1, 32) as id from {customer}")
def fallback_ids(t) -> DataFrame:
    """PRJ-14: equal for equal items in any order."""
    a, b = (F.lit("a"), F.col("c_name")), (F.lit("b"), _text("c_custkey"))
    row = F.when(F.col("c_custkey") % 3 == 0, F.create_map(*a, *b)).otherwise(F.create_map(*b, *a))
    return t("customer").select("c_custkey", tx.fallback_id(row, F.col("c_name"), F.lit(None).cast("string"), F.when(F.col("c_custkey") % 2 == 0, F.lit("051"))).alias("id"))


@query("select c_custkey, 'bsshNm:' || lower(c_name) || case c_custkey % 4 when 0 then 'strasse' when 1 then 'σσ' when 2 then '가ı' else 'é' end as id from {customer}")
def menu_store_ids(t) -> DataFrame:
    """PRJ-15."""
    end = F.get(F.array(*[F.lit(x) for x in ("Straße", "Σς", "가ı", "É")]), (F.col("c_custkey") % 4).cast("int"))
    return t("customer").select("c_custkey", tx.menu_store_id(F.concat("c_name", end)).alias("id"))


@query("select c_custkey, case c_custkey % 3 when 0 then c_name || ' 2' when 1 then c_name end as address from {customer}")
def display_addresses(t) -> DataFrame:
    """PRJ-43."""
    kind = F.col("c_custkey") % 3
    return t("customer").select("c_custkey", tx.display_address(F.when(kind != 2, F.col("c_name")).otherwise(" "), F.when(kind == 0, F.lit("2"))).alias("address"))


@query("""select c_custkey, case c_custkey % 3 when 0 then cast(c_custkey as varchar) when 1 then c_name else '{"x":"' || repeat('y', 114) end as label from {customer}""")
def reject_labels(t) -> DataFrame:
    """PRJ-45."""
    kind = F.col("c_custkey") % 3
    row = F.when(kind == 0, F.create_map(F.lit("name"), F.col("c_name"), F.lit("idx"), _text("c_custkey"))).when(kind == 1, F.create_map(F.lit("idx"), F.lit(""), F.lit("상호"), F.col("c_name"))).otherwise(F.create_map(F.lit("x"), F.lit("y" * 200)))
    return t("customer").select("c_custkey", tx.reject_label(row).alias("label"))


@query("select id, map_x between 128.7 and 129.4 and map_y between 34.8 and 35.5 as inside, address like '%부산%' as in_city from (select id, map_x + 0.25 as map_x, map_y, address from {food_places}) where map_x is not null")
def city_box(t) -> DataFrame:
    """PRJ-37 and PRJ-38."""
    places = t("food_places").withColumn("map_x", F.col("map_x") + 0.25).filter("map_x is not null")
    return places.select("id", in_box(F.col("map_x"), F.col("map_y")).alias("inside"), tx.mentions_city(F.col("address")).alias("in_city"))


@query("select p_brand as regn_cd, cast(p_partkey as varchar) as signgu_cd from {part} where p_brand = (select min(p_brand) from {part})")
def districts_of_area(t) -> DataFrame:
    """SRC-11."""
    codes = t("part").select(F.col("p_brand").alias("regn_cd"), _text("p_partkey").alias("signgu_cd"))
    return normalize.districts(codes, codes.agg(F.min("regn_cd")).first()[0])


@query("""select id, status, case when status <> 'running' then fetched end as fetched, case when status <> 'running' then 'x' end as metadata from {run_log}""")
def run_states(t) -> DataFrame:
    """MUT-20: start and end rows of each run, and the state they leave."""
    runs, none = t("run_log"), F.lit(None)
    row = lambda status, finished, known: runs.select("id", "job_name", F.lit("manual").alias("run_type"), status.alias("status"), at().alias("started_at"), finished.cast("timestamp").alias("finished_at"), *[F.when(known, F.col(c)).cast("long").alias(c) for c in ("fetched", "upserted", "failed")], F.when(known, "x").alias("metadata"))
    starts = row(F.lit("running"), none, F.lit(False))
    ends = row(F.col("status"), at(), F.lit(True)).filter("status <> 'running'")
    return runlog.latest(starts.unionByName(ends)).select("id", "status", "fetched", "metadata")


@query("select cast(p_partkey as varchar) as content_id, p_size as n, case when p_partkey % 3 = 2 then 'old' when p_partkey % 3 = 1 and p_partkey % 2 = 1 then 'old' else 'new' end as stamp from {part} where p_partkey % 3 <> 0 or p_partkey % 2 = 0")
def stamped_upsert(t) -> DataFrame:
    """MUT-21: new and changed rows are stamped, others keep their time."""
    rows = t("part").select(_text(_key()).alias("content_id"), F.col("p_size").alias("n"), "p_partkey")
    old = rows.filter("p_partkey % 3 <> 0").withColumn("n", F.when((_key() % 3 == 1) & (_key() % 2 == 0), F.col("n") + 1).otherwise(F.col("n"))).withColumn("updated_at", F.lit("2000-01-01").cast("timestamp"))
    new = rows.filter("p_partkey % 3 <> 2 and (p_partkey % 3 = 1 or p_partkey % 2 = 0)").select("content_id", "n")
    after = mutations.apply_upsert(old.drop("p_partkey"), new, ["content_id"], stamp=at())
    return after.select("content_id", "n", F.when(F.year("updated_at") == 2000, "old").otherwise("new").alias("stamp"))


@query("select id, case when id % 3 = 0 then 1.5 else map_x end as map_x, case when id % 3 = 0 then null else map_y end as map_y from {food_places}")
def coordinates_set(t) -> DataFrame:
    """MUT-18."""
    places = t("food_places")
    found = places.filter("id % 3 = 0").select("id", F.lit(1.5).alias("map_x"), F.lit(None).cast("double").alias("map_y"))
    return mutations.set_columns(places, found, "id", ["map_x", "map_y"]).select("id", "map_x", "map_y")


@query("""select p_partkey as key, 'single ' || p_name as menu_name, p_size * 1000 as price, 1 as display_order from {part} where p_partkey % 2 = 0
    union all select p_partkey, 'late ' || p_name, p_size * 100, case when p_partkey % 2 = 0 then 2 else 1 end from {part}""")
def menu_headers(t) -> DataFrame:
    """GEN-2 and GEN-3: single-item headers, and numbered pairs beyond the slots."""
    single = F.when(_key() % 2 == 0, F.map_from_arrays(F.array(F.lit("itemNm"), F.lit("menuPrc")), F.array(F.concat(F.lit("single "), "p_name"), _text(F.col("p_size") * 1000))))
    late = F.create_map(F.lit("메뉴 25"), F.concat(F.lit("late "), "p_name"), F.lit("가격 25"), _text(F.col("p_size") * 100), F.lit("key"), _text(_key()))
    row = F.when(single.isNotNull(), F.map_concat(late, single)).otherwise(late)
    found = gen.with_menus(headers.resolved(headers.as_cells(t("part").select(row.alias("row"))), normalize.HEADERS))
    return found.select(F.element_at(headers.as_row(), "key").cast("long").alias("key"), F.inline("menus")).select("key", "menu_name", "price", "display_order")
