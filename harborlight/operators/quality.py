"""Data-quality rules. Each gives rows (table_name, rule, key, value) of what breaks it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Allowed words per table and column.
DOMAINS = {
    ("spots", "content_type_id"): ("12", "14", "28", "39"),
    ("food_places", "normalized_category"): ("food_korean", "food_chinese", "food_japanese", "food_western", "food_cafe", "food_noodle", "food_meat", "food_other", "beauty", "bath", "lodging", "other"),
    ("sources", "source"): ("good_price_shop", "good_price_store", "good_price_menu", "good_price_file", "busan_food", "redtable", "admin_manual"),
    ("observations", "source_type"): ("api", "file_import", "admin_manual", "user_report", "crawler"),
    ("observations", "review_status"): ("pending", "approved", "rejected"),
    ("matches", "match_status"): ("pending", "matched", "rejected", "separate"),
    ("matches", "match_method"): ("rule", "manual", "llm"),
    ("run_log", "run_type"): ("scheduled", "manual", "triggered", "regression"),
    ("run_log", "status"): ("running", "success", "failed", "partial", "cancelled"),
}
# Least and most value per column (None: open).
RANGES = {"map_x": (-180, 180), "map_y": (-90, 90), "price": (0, None), "observed_price": (0, None), "display_order": (1, None), "serial_num": (1, None), "match_score": (0, 1), "taketime_minutes": (0, None), "distance_km": (0, None), "menu_count": (0, None), "min_price": (0, None), "avg_price": (0, None), "total_cost": (0, None), "total_minutes": (0, None)}


def _rows(df: DataFrame, table: str, rule: str, key: str | list[str], bad: Column, value: Column) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    name = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return df.filter(bad).select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), name.alias("key"), value.cast("string").alias("value"))


def domain(df: DataFrame, table: str, column: str, key: str | list[str], allowed: tuple[str, ...] | None = None) -> DataFrame:
    """Values outside the allowed words; null is allowed (DQ-1)."""
    words = allowed or DOMAINS[table, column]
    return _rows(df, table, f"domain:{column}", key, ~F.col(column).isin(*words), F.col(column))


def in_range(df: DataFrame, table: str, column: str, key: str | list[str], bounds: tuple | None = None) -> DataFrame:
    """Values outside the range; null is allowed (DQ-2)."""
    least, most = bounds or RANGES[column]
    bad = F.lit(False)
    if least is not None:
        bad = bad | (F.col(column) < least)
    if most is not None:
        bad = bad | (F.col(column) > most)
    return _rows(df, table, f"range:{column}", key, bad, F.col(column))


def separate_without_spot(matches: DataFrame, key: str | list[str]) -> DataFrame:
    """Matches where being separate and having no spot do not go together (DQ-3)."""
    bad = (F.col("match_status") == "separate") != F.col("spot_content_id").isNull()
    return _rows(matches, "matches", "separate_without_spot", key, bad, F.col("match_status"))


def unique(df: DataFrame, table: str, keys: list[str], where: Column | None = None) -> DataFrame:
    """Keys that occur more than once, with their number; where: only among these rows (DQ-4)."""
    rows = df if where is None else df.filter(where)
    counted = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    return _rows(counted, table, "unique:" + ",".join(keys), keys, F.col("_n") > 1, F.col("_n"))


def references(df: DataFrame, table: str, column: str, key: str | list[str], parents: DataFrame, parent_key: str) -> DataFrame:
    """Non-null references that name nothing (DQ-5)."""
    lost = df.filter(F.col(column).isNotNull()).join(parents.select(F.col(parent_key).alias(column)).distinct(), column, "left_anti")
    return _rows(lost, table, f"reference:{column}", key, F.lit(True), F.col(column))


def required(df: DataFrame, table: str, column: str, key: str | list[str], most: int | None = None) -> DataFrame:
    """Nulls, and texts longer than most (DQ-6)."""
    bad = F.col(column).isNull() if most is None else F.col(column).isNull() | (F.length(column) > most)
    return _rows(df, table, f"required:{column}", key, bad, F.length(F.col(column).cast("string")))


def mixed_coordinates(places: DataFrame, key: str | list[str]) -> DataFrame:
    """Places with one coordinate only."""
    return _rows(places, "food_places", "mixed_coordinates", key, F.col("map_x").isNull() != F.col("map_y").isNull(), F.coalesce("map_x", "map_y"))


def check_fields(df: DataFrame, allowed: list[str]) -> DataFrame:
    """df; raises for columns that the schema does not know (DQ-7)."""
    if unknown := [c for c in df.columns if c not in allowed]:
        raise ValueError(f"unknown fields: {unknown}")
    return df


def all_of(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
