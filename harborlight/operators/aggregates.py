"""Summaries, coverage and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlight.functions.text import half_up_mean
from harborlight.operators.mutations import fill_blank


def spot_price_summary(menus: DataFrame, matches: DataFrame) -> DataFrame:
    """Prices of each matched spot (JN-1, FLT-7, WIN-1, AGG-1): least and mean price, counts, representative menu.

    The representative is a marked menu, else the cheapest; then display order (none last), name and place decide.
    """
    firm = matches.filter("match_status = 'matched' and spot_content_id is not null").select("food_place_id", "spot_content_id")
    priced = menus.filter("price > 0").join(firm, "food_place_id")
    rank = F.struct((~F.coalesce("is_representative", F.lit(False))).alias("later"), "price", F.col("display_order").isNull().alias("unordered"), "display_order", "menu_name", "food_place_id")
    # the least rank is added up before the shuffle, so a spot with very many menus is no burden to one task
    summed = priced.groupBy("spot_content_id").agg(
        F.min("price").alias("min_price"),
        half_up_mean("price").alias("avg_price"),
        F.min(rank).alias("first"),
        F.count("*").cast("int").alias("menu_count"),
        F.countDistinct("food_place_id").cast("int").alias("food_place_count"),
    )
    return summed.select("spot_content_id", "min_price", "avg_price", F.col("first.menu_name").alias("representative_menu_name"), F.col("first.price").alias("representative_price"), "menu_count", "food_place_count")


def newest_by_name(stores: DataFrame) -> DataFrame:
    """Newest addressed, active store of each name (WIN-2)."""
    good = stores.filter("is_active and trim(address) <> ''")
    newest = Window.partitionBy("name").orderBy(F.col("id").desc())
    return good.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def _blank(c: str):
    return F.coalesce(F.trim(F.col(c)), F.lit("")) == ""


def enrich_candidates(menu_places: DataFrame, stores: DataFrame) -> DataFrame:
    """Active menu places with a gap and a store of their name: id, store_* columns and needs_* flags (JN-2, FLT-12)."""
    cols = ("address", "tel", "source_region", "map_x", "map_y")
    named = newest_by_name(stores).select("name", *[F.col(c).alias(f"store_{c}") for c in cols])
    flags = {"needs_address": _blank("address"), "needs_tel": _blank("tel"), "needs_source_region": _blank("source_region"), "needs_coords": F.col("map_x").isNull() | F.col("map_y").isNull()}
    rows = menu_places.filter("is_active").withColumns(flags).filter(" or ".join(flags)).join(named, "name")
    return rows.select("id", *[f"store_{c}" for c in cols], *flags)


def no_store_count(menu_places: DataFrame, stores: DataFrame) -> DataFrame:
    """Number of active menu places without an addressed store of their name (JN-3)."""
    return menu_places.filter("is_active").join(newest_by_name(stores).select("name"), "name", "left_anti").agg(F.count("*").alias("no_store_match"))


def enrich_flags(candidates: DataFrame) -> DataFrame:
    """candidates with fills_address, fills_coords, fills_tel and enriched; only a missing district does not count."""
    filled = {
        "fills_address": F.col("needs_address") & (F.coalesce("store_address", F.lit("")) != ""),
        "fills_coords": F.col("needs_coords") & F.col("store_map_x").isNotNull() & F.col("store_map_y").isNotNull(),
        "fills_tel": F.col("needs_tel") & (F.coalesce("store_tel", F.lit("")) != ""),
    }
    return candidates.withColumns(filled).withColumn("enriched", F.col("fills_address") | F.col("fills_coords") | F.col("fills_tel"))


def enrich_counters(menu_places: DataFrame, stores: DataFrame) -> DataFrame:
    """Counters of the enrichment (AGG-5)."""
    flagged = enrich_flags(enrich_candidates(menu_places, stores))
    counts = flagged.agg(F.count("*").alias("store_name_matches"), F.count_if("enriched").alias("enriched_count"), F.count_if("fills_address").alias("address_filled"), F.count_if("fills_coords").alias("coords_filled"), F.count_if("fills_tel").alias("tel_filled"))
    scanned = menu_places.filter("is_active").agg(F.count("*").alias("menu_places_scanned"))
    parts = scanned.unionByName(counts, allowMissingColumns=True).unionByName(no_store_count(menu_places, stores), allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def enrich(menu_places: DataFrame, stores: DataFrame) -> DataFrame:
    """Menu places with the gaps of enriched ones filled, column by column (MUT-12)."""
    ids = enrich_flags(enrich_candidates(menu_places, stores)).filter("enriched").select(F.col("id").alias("_enriched"))
    marked = menu_places.join(ids, F.col("id") == F.col("_enriched"), "left")
    return fill_blank(marked, newest_by_name(stores), "name", ["address", "tel", "source_region"], ["map_x", "map_y"], F.col("_enriched").isNotNull()).drop("_enriched")


def upcoming_rates(forecasts: DataFrame, as_of, days: int = 3) -> DataFrame:
    """Mean rate of the days after as_of per spot, two places (AGG-2)."""
    ahead = forecasts.filter(F.col("content_id").isNotNull() & F.col("base_ymd").between(F.date_add(as_of, 1), F.date_add(as_of, days)))
    return ahead.groupBy("content_id").agg(F.round(F.avg("rate"), 2).cast("decimal(5,2)").alias("upcoming"))


def congestion_rates(forecasts: DataFrame, as_of) -> DataFrame:
    """Today's rate of each spot with the mean of the next days, if any (JN-7)."""
    today = forecasts.filter(F.col("content_id").isNotNull() & (F.col("base_ymd") == as_of)).select("content_id", F.col("rate").alias("today"))
    return today.join(upcoming_rates(forecasts, as_of), "content_id", "left")


def active_and_candidates(spots: DataFrame, base, candidate) -> DataFrame:
    """active_count and candidate_count in one pass (AGG-3)."""
    return spots.agg(F.count_if(base & F.col("is_active")).alias("active_count"), F.count_if(candidate).alias("candidate_count"))


def congestion_metrics(rows: DataFrame, by: list[str]) -> DataFrame:
    """null_ratio, match_rate and failure_rate of runs (AGG-6); nothing counts as 1 below. rows: fetched, upserted, failed, unmatched."""
    sums = rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("fetched", "upserted", "failed", "unmatched")])
    stored = F.greatest(F.col("upserted"), F.lit(1))
    ratios = {"null_ratio": F.col("unmatched") / stored, "match_rate": (F.col("upserted") - F.col("unmatched")) / stored, "failure_rate": F.col("failed") / F.greatest(F.col("fetched"), F.lit(1))}
    return sums.withColumns(ratios)


def first_real_name(codes: DataFrame, pending: str = "pending_sync") -> DataFrame:
    """One row per code triple with its first real name, else the pending mark (AGG-7). codes: code1..3, name, ordinal."""
    real = F.min_by(F.when(F.col("name") != pending, F.col("name")), F.when(F.col("name") != pending, F.col("ordinal")))
    return codes.groupBy("code1", "code2", "code3").agg(F.coalesce(real, F.lit(pending)).alias("name"))


def coverage(places: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: places, with address, with point (AGG-8, JN-13)."""
    joined = sources.select("source", "food_place_id").join(places.filter("is_active"), F.col("food_place_id") == F.col("id"))
    return joined.groupBy("source").agg(F.count("*").alias("places"), F.count_if(F.coalesce(F.trim("address"), F.lit("")) != "").alias("with_address"), F.count_if(F.col("map_x").isNotNull() & F.col("map_y").isNotNull()).alias("with_point"))


def histogram(rows: DataFrame, *by: str) -> DataFrame:
    """Rows per value (AGG-9)."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def top_courses(items: DataFrame, n: int = 20) -> DataFrame:
    """Courses with the most items (AGG-10)."""
    return items.groupBy("course_id").agg(F.count("*").alias("items")).orderBy(F.col("items").desc(), "course_id").limit(n)


def missing_raw(courses: DataFrame, raw: DataFrame, key: str = "content_id") -> DataFrame:
    """Courses without raw snapshot (JN-11)."""
    return courses.join(raw.select(key), key, "left_anti")


def outcome_counters(results: DataFrame, column: str = "outcome", outcomes: tuple[str, ...] = ("resolved", "failed", "low_confidence", "outside")) -> DataFrame:
    """scanned and the number of each outcome (AGG-11)."""
    return results.agg(F.count("*").alias("scanned"), *[F.count_if(F.col(column) == o).alias(o) for o in outcomes])


def top_menus(menus: DataFrame, n: int = 8) -> DataFrame:
    """Names of the first n menus of each place in order (WIN-3): food_place_id, menu_names."""
    order = Window.partitionBy("food_place_id").orderBy(F.coalesce("is_representative", F.lit(False)).desc(), F.col("display_order").asc_nulls_last(), "menu_name")
    ranked = menus.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n)
    listed = F.array_sort(F.collect_list(F.struct("_n", "menu_name")))
    return ranked.groupBy("food_place_id").agg(F.transform(listed, lambda m: m["menu_name"]).alias("menu_names"))


def map_places(spots: DataFrame, places: DataFrame, summary: DataFrame) -> DataFrame:
    """Active spots and food places in one table, spots with their least price (MAP-1)."""
    own = spots.filter("is_active").join(summary.select(F.col("spot_content_id").alias("content_id"), "min_price"), "content_id", "left")
    first = own.select(F.lit("spot").alias("place_type"), F.col("content_id").alias("original_id"), F.col("title").alias("name"), "map_x", "map_y", "min_price")
    second = places.filter("is_active").select(F.lit("food").alias("place_type"), F.col("id").cast("string").alias("original_id"), "name", "map_x", "map_y", F.lit(None).cast("int").alias("min_price"))
    return first.unionByName(second)
