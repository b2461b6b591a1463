"""Rows from landed API payloads (JSON or XML text). Malformed payloads give no rows and can be listed as rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Landed payloads have at least: payload STRING.
DETAIL_ENDPOINTS = ("detailCommon2", "detailIntro2", "detailInfo2", "detailImage2")


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _as_list(v: Column) -> Column:
    """A variant that is a list as array<variant>; a single object as a list of one."""
    kind = F.schema_of_variant(v)
    return F.when(kind.startswith("ARRAY"), v.try_cast("array<variant>")).when(kind.startswith("OBJECT"), F.array(v))


def _objects(items: Column) -> Column:
    return F.filter(items, lambda i: i.isNotNull() & F.schema_of_variant(i).startswith("OBJECT"))


def parsed(df: DataFrame, payload: str = "payload") -> DataFrame:
    """df with `_v`, the payload as variant (null if malformed)."""
    return df.withColumn("_v", F.try_parse_json(payload))


def _explode(df: DataFrame, items: Column) -> DataFrame:
    kept = [c for c in df.columns if c not in ("_v", "item", "ordinal")]
    return df.select(*kept, F.posexplode(_objects(items)).alias("ordinal", "item"))


def list_items(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per item of response.body.items.item, a list or one object (SRC-1): other columns, ordinal, item (variant)."""
    rows = parsed(df, payload)
    return _explode(rows, _as_list(_get(F.col("_v"), "$.response.body.items.item")))


def page_sizes(df: DataFrame, payload: str = "payload") -> DataFrame:
    """df with `items`, the number of items of each list page; 0 for a page without any."""
    found = _objects(_as_list(_get(F.try_parse_json(payload), "$.response.body.items.item")))
    return df.withColumn("items", F.coalesce(F.size(found), F.lit(0)))


def first_item(v: Column) -> Column:
    """First item of a detail envelope (SRC-2)."""
    return F.get(_objects(_as_list(_get(v, "$.response.body.items.item"))), F.lit(0))


FLEXIBLE = ("$.items", "$.item", "$.data", "$.body.items", "$.response.body.items", "$.response.body.item", "$.response.body.data", "$.response.body.items.item")


def flexible_items(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Items of the first list, or non-empty object, among the known places of an envelope (SRC-3)."""
    rows = parsed(df, payload)
    found = None
    for path in FLEXIBLE:
        place = _get(F.col("_v"), path)
        kind = F.schema_of_variant(place)
        inner = _as_list(_get(place, "$.item"))
        value = F.when(kind.startswith("ARRAY"), place.try_cast("array<variant>")).when(kind.startswith("OBJECT") & (kind != "OBJECT<>"), F.coalesce(inner, F.array(place)))
        found = value if found is None else F.coalesce(found, value)
    return _explode(rows, found)


def course_items(v: Column) -> Column:
    """Sub-items of a course envelope, or the payload itself if it is one (SRC-5): array<variant>."""
    listed = _objects(_as_list(_get(v, "$.response.body.items.item")))
    return F.coalesce(listed, F.when(_get(v, "$.subcontentid", "string").isNotNull(), F.array(v)), F.array().cast("array<variant>"))


def geocode_point(v: Column) -> Column:
    """x and y of the first document of an address response, null if either is missing (SRC-6)."""
    x, y = _get(v, "$.documents[0].x", "double"), _get(v, "$.documents[0].y", "double")
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


def keyword_documents(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per document of a keyword response: place_name, phone, x, y, address (PRJ-40), and its position."""
    rows = _explode(parsed(df, payload), _get(F.col("_v"), "$.documents").try_cast("array<variant>"))
    item = F.col("item")
    text = lambda n: _get(item, f"$.{n}", "string")
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    address = F.coalesce(blank(text("road_address_name")), blank(text("address_name")))
    return rows.withColumns({"place_name": text("place_name"), "phone": text("phone"), "x": text("x").try_cast("double"), "y": text("y").try_cast("double"), "address": address}).drop("item")


def split_errors(df: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(good, errors): errors carry result_code and message from JSON headers (SRC-7) or XML bodies (SRC-8)."""
    body = F.ltrim(F.col(payload))
    xml = body.startswith("<")
    v = F.try_parse_json(payload)
    code = F.coalesce(_get(v, "$.response.header.resultCode", "string"), _get(v, "$.resultCode", "string"))
    note = F.coalesce(_get(v, "$.response.header.resultMsg", "string"), _get(v, "$.resultMsg", "string"))
    tag = lambda name: F.nullif(F.regexp_extract(body, f"<{name}>([^<]*)</{name}>", 1), F.lit(""))
    marked = df.withColumns({
        "result_code": F.when(xml, F.coalesce(tag("returnReasonCode"), F.lit("xml"))).when(v.isNull(), "malformed").otherwise(code),
        "message": F.when(xml, F.concat_ws(": ", tag("returnAuthMsg"), tag("errMsg"))).otherwise(note),
    })
    bad = F.coalesce(F.col("result_code") != "0000", F.lit(False))
    return marked.filter(~bad).drop("result_code", "message"), marked.filter(bad)


def combine_details(df: DataFrame, content_id: str = "content_id") -> DataFrame:
    """Landed (content_id, endpoint, payload) as one row per id with a column per endpoint (SRC-10)."""
    return df.groupBy(content_id).pivot("endpoint", list(DETAIL_ENDPOINTS)).agg(F.first("payload", ignorenulls=True))


def item_map(item: Column) -> Column:
    """An item as map of text to text."""
    return item.try_cast("map<string,string>")


def item_id(item: Column) -> Column:
    """Id of a listed item, whether text or number (PRJ-46)."""
    return F.nullif(F.trim(_get(item, "$.contentid", "string")), F.lit(""))


def modified_text(item: Column) -> Column:
    """Modified time of a listed item as text (PRJ-46)."""
    return F.nullif(F.trim(_get(item, "$.modifiedtime", "string")), F.lit(""))


def raw_snapshot(payloads: dict[str, Column], fetched_at: Column) -> Column:
    """The stored document of all endpoints: data (an empty object if there is none) and fetch time of each (PRJ-22)."""
    one = lambda c: F.struct(F.coalesce(F.try_parse_json(c), F.parse_json(F.lit("{}"))).alias("data"), F.date_format(fetched_at, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("fetched_at"))
    return F.to_json(F.struct(F.struct(*[one(payloads[e]).alias(e) for e in DETAIL_ENDPOINTS]).alias("endpoints")))
