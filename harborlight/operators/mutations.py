"""Keyed changes of tables. Each returns the new snapshot as a DataFrame; nothing is written here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_write(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys the last in `order` (WIN-9)."""
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return batch.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")


def apply_upsert(target: DataFrame, batch: DataFrame, keys: list[str], policy: dict[str, str | Column] | None = None, null_safe: bool = False, stamp: Column | None = None) -> DataFrame:
    """target with batch inserted or merged by keys (MUT-1 to MUT-3, 6, 8 to 10, 14).

    Columns that only target has stay (null in new rows). policy per column: 'overwrite' (default), 'keep_non_null' (an
    incoming null keeps the old value), 'keep' (only inserts set it), 'or' (true stays true), or a Column over t.* and b.*.
    With `stamp`, updated_at is set to it where a row is new or any of its columns changed (MUT-21). batch has unique keys.
    """
    policy = policy or {}
    t, b = target.withColumn("_t", F.lit(True)).alias("t"), batch.withColumn("_b", F.lit(True)).alias("b")
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}")) if null_safe else F.col(f"t.{k}") == F.col(f"b.{k}") for k in keys]
    new, both = F.col("t._t").isNull(), F.col("t._t") & F.col("b._b")
    merged: dict[str, Column] = {}
    for c in target.columns:
        old = F.col(f"t.{c}")
        if c in keys:
            merged[c] = F.when(new, F.col(f"b.{c}")).otherwise(old)
            continue
        if c not in batch.columns and not isinstance(policy.get(c), Column):
            merged[c] = old
            continue
        fresh, how = F.col(f"b.{c}") if c in batch.columns else F.lit(None), policy.get(c, "overwrite")
        if isinstance(how, Column):
            value = how
        elif how == "keep_non_null":
            value = F.coalesce(fresh, old)
        elif how == "or":
            value = F.coalesce(old, F.lit(False)) | F.coalesce(fresh, F.lit(False))
        else:
            value = old if how == "keep" else fresh
        merged[c] = F.when(new, how if isinstance(how, Column) else fresh).when(both, value).otherwise(old)
    if stamp is not None:
        changed = F.lit(False)
        for c, value in merged.items():
            if c not in keys and c != "updated_at":
                changed = changed | ~value.eqNullSafe(F.col(f"t.{c}"))
        merged["updated_at"] = F.when(new | (both & changed), stamp).otherwise(F.col("t.updated_at"))
    return t.join(b, on, "full_outer").select(*[v.alias(k) for k, v in merged.items()])


def replace_children(target: DataFrame, children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children of the batch's parents replaced; a parent without new children loses its old ones (MUT-4, MUT-7)."""
    kept = target.join(parents.select(key).distinct(), key, "left_anti")
    return kept.unionByName(children.select(*target.columns))


def existing_or_null(rows: DataFrame, column: str, known: DataFrame, known_key: str) -> DataFrame:
    """rows with `column` null where it names nothing in known (JN-8)."""
    ids = known.select(F.col(known_key).alias("_known")).distinct()
    joined = rows.join(ids, F.col(column) == F.col("_known"), "left")
    return joined.withColumn(column, F.col("_known")).select(rows.columns)


def of_run(region: str, types: list[str]) -> Column:
    """Condition: active spots from the API that a run over region and types should meet."""
    return (F.col("l_dong_regn_cd") == region) & F.col("content_type_id").isin(types) & F.col("source_tour_api") & F.col("is_active")


def deactivation_candidates(spots: DataFrame, region: str, types: list[str], started: Column) -> Column:
    """Condition: active spots of region and types that this run has not read (FLT-6)."""
    return of_run(region, types) & (F.col("synced_at") < started)


def deactivate(spots: DataFrame, condition: Column, at: Column) -> tuple[DataFrame, DataFrame]:
    """(spots with the matching ones inactive since `at`, their ids); a second call changes nothing (MUT-5)."""
    hit = F.coalesce(condition & F.col("is_active"), F.lit(False))
    ids = spots.filter(hit).select("content_id")
    after = spots.withColumns({"inactive_since": F.when(hit, at).otherwise(F.col("inactive_since")), "is_active": F.when(hit, F.lit(False)).otherwise(F.col("is_active"))})
    return after, ids


def mark_listed(spots: DataFrame, listing: DataFrame) -> DataFrame:
    """spots with `_seen`, null where the run's listing does not have the spot."""
    seen = listing.select(F.col("content_id").alias("_seen")).distinct()
    return spots.join(seen, F.col("content_id") == F.col("_seen"), "left")


def deactivate_unlisted(spots: DataFrame, listing: DataFrame, condition: Column, at: Column) -> tuple[DataFrame, DataFrame]:
    """Like deactivate, but a spot is missing if the run's listing does not have it, whether or not it was re-read."""
    after, ids = deactivate(mark_listed(spots, listing), condition & F.col("_seen").isNull(), at)
    return after.drop("_seen"), ids


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """History: rows added as they come (MUT-11)."""
    return target.unionByName(rows.select(*target.columns))


def changed_prices(observations: DataFrame, keys: list[str], price: str, order: list[str]) -> DataFrame:
    """Observations whose price differs from the one before it."""
    before = F.lag(price).over(Window.partitionBy(*keys).orderBy(*order))
    return observations.withColumn("_before", before).filter(~F.col(price).eqNullSafe(F.col("_before"))).drop("_before")


def fill_blank(target: DataFrame, source: DataFrame, key: str, text: list[str], other: list[str], where: Column | None = None) -> DataFrame:
    """Blank columns of target filled from source, each by itself (MUT-12)."""
    named = source.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in text + other])
    joined = target.join(named, F.col(key) == F.col("_key"), "left")
    use = F.col("_key").isNotNull() if where is None else F.col("_key").isNotNull() & where
    filled = {c: F.when(use, F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.col(f"_new_{c}"))).otherwise(F.col(c)) for c in text}
    filled |= {c: F.when(use, F.coalesce(F.col(c), F.col(f"_new_{c}"))).otherwise(F.col(c)) for c in other}
    return joined.withColumns(filled).select(target.columns)


def prune(target: DataFrame, produced: DataFrame, key: str) -> DataFrame:
    """Rows whose key is still produced (MUT-15, JN-10)."""
    return target.join(produced.select(key).distinct(), key, "left_semi")


def insert_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with new keys added, known ones left alone (MUT-19)."""
    return target.unionByName(rows.dropDuplicates(keys).join(target, keys, "left_anti").select(*target.columns))


def set_columns(target: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The named columns set for the keys in updates (MUT-18)."""
    named = updates.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(named, F.col(key) == F.col("_key"), "left")
    return joined.withColumns({c: F.when(F.col("_key").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}).select(target.columns)


def purge_before(forecasts: DataFrame, as_of: Column, days: int = 7, column: str = "base_ymd") -> DataFrame:
    """Rows no older than `days` before as_of (FLT-8)."""
    return forecasts.filter(F.col(column) >= F.date_sub(as_of, days))


MATCHED_KEY = ["content_id", "base_ymd", "source"]
UNMATCHED_KEY = ["area_cd", "signgu_cd", "raw_tats_name", "base_ymd", "source"]


def upsert_forecasts(target: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    """Forecasts with a spot by one key, those without by another; an unmatched row stays when its name is matched later (MUT-17)."""
    parts = []
    for known, keys in ((True, MATCHED_KEY), (False, UNMATCHED_KEY)):
        own = F.col("content_id").isNotNull() if known else F.col("content_id").isNull()
        rows = last_write(batch.filter(own), keys, order).drop(*[c for c in order if c not in target.columns])
        parts.append(apply_upsert(target.filter(own), rows, keys))
    return parts[0].unionByName(parts[1])


def require_source(batch: DataFrame, column: str, allowed: str) -> DataFrame:
    """batch; running it fails if any row has another source (FLT-11)."""
    checked = F.when(F.col(column) == allowed, F.col(column)).otherwise(F.raise_error(F.concat(F.lit("source not allowed: "), F.coalesce(column, F.lit("null")))).cast("string"))
    return batch.withColumn(column, checked)


def cascade(children: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Children whose parent exists, and those that name none: ON DELETE CASCADE (MUT-22)."""
    known = parents.select(F.col(parent_key).alias("_known")).distinct()
    joined = children.join(known, F.col(key) == F.col("_known"), "left")
    return joined.filter(F.col("_known").isNotNull() | F.col(key).isNull()).select(children.columns)


def orphans(children: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Children whose parent is gone: what ON DELETE RESTRICT would refuse (MUT-22)."""
    return children.filter(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def write_matches(target: DataFrame, decided: DataFrame) -> DataFrame:
    """Rule matches of the decided places replaced; a manual row of the same pair is overwritten (MUT-13).

    decided: food_place_id, spot_content_id, match_score, match_status; a separate place has no spot.
    """
    rows = decided.select("food_place_id", F.when(F.col("match_status") != "separate", F.col("spot_content_id")).alias("spot_content_id"), "match_score", "match_status", F.lit("rule").alias("match_method"))
    done = rows.select("food_place_id").distinct().withColumn("_done", F.lit(True))
    pair = rows.filter("spot_content_id is not null").select("food_place_id", "spot_content_id").withColumn("_pair", F.lit(True))
    marked = target.join(done, "food_place_id", "left").join(pair, ["food_place_id", "spot_content_id"], "left")
    rule = F.coalesce(F.col("_done") & (F.col("match_method") == "rule"), F.lit(False))
    kept = marked.filter(~rule & F.col("_pair").isNull()).select(target.columns)
    return kept.unionByName(rows.select(*target.columns))


def update_congestion(spots: DataFrame, rates: DataFrame, at: Column) -> DataFrame:
    """Cached rates of active spots that have a row today; the others keep theirs (MUT-16). rates: content_id, today, upcoming."""
    named = rates.select(F.col("content_id").alias("_id"), F.col("today").alias("_today"), F.col("upcoming").alias("_upcoming"))
    joined = spots.join(named, (F.col("content_id") == F.col("_id")) & F.col("is_active"), "left")
    hit = F.col("_id").isNotNull()
    pairs = {"today_concentration_rate": F.col("_today"), "upcoming_avg_rate": F.col("_upcoming"), "congestion_updated_at": at}
    return joined.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in pairs.items()}).select(spots.columns)
