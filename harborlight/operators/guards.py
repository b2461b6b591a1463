"""Gates in front of destructive steps. Each looks at one row of figures and gives the reason to skip, or None to go on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_FAILURE, MAX_DEACTIVATION, MAX_NULL = 0.05, 0.2, 0.3
MIN_MATCH = 0.9


def deactivation_reason(row: dict[str, Column], max_failure: float = MAX_FAILURE, max_ratio: float = MAX_DEACTIVATION) -> Column:
    """Reason not to deactivate, null if safe (GRD-1). row: stopped_by_budget, complete, fetched, failed, active_count, candidate_count."""
    failure = row["failed"] / F.greatest(row["fetched"], F.lit(1))
    ratio = F.when(row["active_count"] > 0, row["candidate_count"] / row["active_count"]).otherwise(0.0)
    return (
        F.when(F.coalesce(row["stopped_by_budget"], F.lit(False)), "stopped_by_budget")
        .when(~F.coalesce(row["complete"], F.lit(False)), "partial_sync")
        .when(failure >= max_failure, "high_failure_rate")
        .when(ratio >= max_ratio, "high_deactivation_ratio")
    )


def cache_reason(row: dict[str, Column], max_failure: float = MAX_FAILURE, max_null: float = MAX_NULL, min_match: float | None = None) -> Column:
    """Reason not to refresh the cache, null if safe (GRD-2). row: run_id (null: no run), complete, stopped_by_budget, fetched, upserted, failed, unmatched.

    With min_match, a lower match rate is a reason too (GRD-4; off by default).
    """
    stored = F.greatest(row["upserted"], F.lit(1))
    reason = (
        F.when(row["run_id"].isNull(), "no_previous_sync")
        .when(~F.coalesce(row["complete"], F.lit(False)), "partial_sync")
        .when(F.coalesce(row["stopped_by_budget"], F.lit(False)), "stopped_by_budget")
        .when(row["failed"] / F.greatest(row["fetched"], F.lit(1)) >= max_failure, "high_failure_rate")
        .when(F.coalesce(row["unmatched"], F.lit(0)) / stored >= max_null, "high_null_ratio")
    )
    return reason if min_match is None else reason.when((row["upserted"] - row["unmatched"]) / stored < min_match, "low_match_rate")


def listing_complete(pages: DataFrame, types: list[str], full: int) -> DataFrame:
    """One row: whether every content type reached its last page, one with fewer than `full` items (GRD-3). pages: content_type_id, page, items."""
    per_type = pages.groupBy("content_type_id").agg(F.bool_or(F.col("items") < full).alias("terminal")).filter(F.col("content_type_id").isin(types))
    return per_type.agg((F.coalesce(F.bool_and("terminal"), F.lit(False)) & (F.count("*") == len(types))).alias("complete"))


def decide(figures: DataFrame, reason: Column) -> tuple[str | None, dict]:
    """(reason or None, the figures): the one row is brought to the driver; failing to get it is the reason 'exception'."""
    try:
        row = figures.withColumn("reason", reason).first()
    except Exception as error:  # noqa: BLE001 a gate that fails must not fail the run
        return "exception", {"error": str(error)[:300]}
    return (row["reason"], row.asDict()) if row is not None else ("no_previous_sync", {})
