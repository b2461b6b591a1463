"""Locating places from landed geocoder and model responses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlight.functions import text as tx
from harborlight.functions.similarity import phone_score
from harborlight.functions.spatial import in_box
from harborlight.operators.aggregates import top_menus
from harborlight.operators.normalize import rank_in
from harborlight.sources import envelopes as env

MIN_NAME, MIN_CONFIDENCE = 0.75, 0.75


def geocode_requests(targets: DataFrame) -> DataFrame:
    """id and query of each place with an address (PRJ-36)."""
    return targets.select("id", tx.geocode_query(F.col("address")).alias("query"))


def resolve_addresses(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """requests with x, y and outcome 'resolved' or 'failed', from landed (query, payload) responses (SRC-6)."""
    points = responses.select("query", env.geocode_point(F.try_parse_json("payload")).alias("_p"))
    joined = requests.join(points, "query", "left")
    return joined.select("id", "query", F.col("_p.x").alias("map_x"), F.col("_p.y").alias("map_y"), F.when(F.col("_p").isNotNull(), "resolved").otherwise("failed").alias("outcome"))


def keyword_requests(targets: DataFrame) -> DataFrame:
    """id, query_pos, query: search texts of each place in order (PRJ-39)."""
    return targets.select("id", F.posexplode(tx.keyword_queries(F.col("name"), F.col("source_region"))).alias("query_pos", "query"))


def best_documents(documents: DataFrame, similarity: Callable[[Column, Column], Column]) -> DataFrame:
    """Best acceptable document per (id, query_pos), then the first query that has one (SIM-11, FLT-14, WIN-7, WIN-8).

    documents: id, name, tel, query_pos, query, ordinal, place_name, phone, x, y, address. similarity is at most 1, and 1 for equal names:
    an acceptable document with the place's telephone or name leaves only earlier queries to compare.
    """
    named = F.col("place_name").isNotNull()
    a, b = tx.match_name(F.col("name")), tx.match_name(F.col("place_name"))
    phone = phone_score(F.col("tel"), F.col("phone"))
    city = F.col("address").isNull() | tx.mentions_city(F.col("address"))
    open_ = documents.filter(named & in_box(F.col("x"), F.col("y")) & city)
    place = F.struct("query_pos", "ordinal")
    sure = F.min(F.when((phone == 1) | (a == b), place)).over(Window.partitionBy("id"))
    left = open_.withColumn("_sure", sure).filter(F.col("_sure").isNull() | (F.col("query_pos") < F.col("_sure.query_pos")) | (place == F.col("_sure")))
    # A sure document needs no comparison: it gets two empty names, which are equal.
    is_sure = F.coalesce(place == F.col("_sure"), F.lit(False))
    score = F.greatest(similarity(F.when(is_sure, "").otherwise(a), F.when(is_sure, "").otherwise(b)), phone)
    good = left.withColumn("score", score).filter(F.col("score") >= MIN_NAME)
    ranked = good.withColumn("_n", rank_in(["id"], [F.col("query_pos"), F.col("score").desc(), F.col("ordinal")])).filter("_n = 1")
    return ranked.select("id", "query", "x", "y", "address", "score")


def inference_requests(targets: DataFrame, menus: DataFrame) -> DataFrame:
    """id and request text for the address model: place fields and up to eight menus (PRJ-41, WIN-3)."""
    listed = top_menus(menus)
    joined = targets.join(listed, F.col("id") == F.col("food_place_id"), "left")
    none = "(없음)"
    show = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(none))
    lines = F.when(F.size(F.coalesce("menu_names", F.array().cast("array<string>"))) > 0, F.concat(F.lit("- "), F.array_join("menu_names", "\n- "))).otherwise(f"- {none}")
    # The request's wording.
    text = F.concat(
        F.lit("다음은 부산광역시 착한가격업소 후보입니다. 실제 존재할 법한 부산 내 주소를 추론하세요.\n확실하지 않으면 confidence를 낮게 주세요. 다른 도시 주소는 금지입니다.\n\n업소명: "), F.col("name"),
        F.lit("\n구군/동: "), show("source_region"), F.lit("\n전화: "), show("tel"), F.lit("\n대표메뉴: "), show("representative_menu"),
        F.lit("\n메뉴:\n"), lines, F.lit('\n\nJSON만 반환: {"address":"...", "confidence":0.0, "reason":"..."}'),
    )
    return joined.select("id", text.alias("request"))


def parse_inferences(responses: DataFrame) -> DataFrame:
    """id, address, confidence, reason of well-formed answers (PRJ-42): others are dropped. responses: id, raw."""
    v = F.try_parse_json("raw")
    keys = F.coalesce(F.json_object_keys("raw"), F.array().cast("array<string>"))
    known = F.size(F.array_except(keys, F.array(F.lit("address"), F.lit("confidence"), F.lit("reason")))) == 0
    rows = responses.filter(known & v.isNotNull()).select("id", tx.blank_to_null(F.try_variant_get(v, "$.address", "string")).alias("address"), F.try_variant_get(v, "$.confidence", "double").alias("confidence"), tx.strip(F.coalesce(F.try_variant_get(v, "$.reason", "string"), F.lit(""))).alias("reason"))
    return rows.filter("address is not null and confidence between 0 and 1")


def accept_inferences(inferences: DataFrame, responses: DataFrame) -> DataFrame:
    """Confident answers in the city whose address the geocoder puts into the area (FLT-13): id, address, map_x, map_y, outcome."""
    asked = inferences.withColumn("query", tx.geocode_query(F.col("address")))
    points = responses.select("query", env.geocode_point(F.try_parse_json("payload")).alias("_p"))
    joined = asked.join(points, "query", "left")
    outcome = (
        F.when((F.col("confidence") < MIN_CONFIDENCE), "low_confidence")
        .when(~tx.mentions_city(F.col("address")), "outside")
        .when(F.col("_p").isNull(), "failed")
        .when(~in_box(F.col("_p.x"), F.col("_p.y")), "outside")
        .otherwise("resolved")
    )
    return joined.select("id", "address", F.col("_p.x").alias("map_x"), F.col("_p.y").alias("map_y"), outcome.alias("outcome"))
