"""User-level jobs: each takes the current tables and landed inputs and returns new snapshots by name, plus `metrics` of one row.

The functions write nothing; run_job() publishes what they return, or not (dry run), and keeps the run log.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlight.functions.similarity import RADIUS
from harborlight.operators import aggregates as agg
from harborlight.operators import geocode, guards, headers, matching, mutations, normalize, runlog
from harborlight.session import counted, stored
from harborlight.sources import envelopes as env
from harborlight.sources import files

Tables = dict[str, DataFrame]


def _only(target: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.select(*[c for c in rows.columns if c in target.columns])


def _figures(**counts: DataFrame) -> DataFrame:
    """One row with the number of rows of each table."""
    rows = None
    for name, df in counts.items():
        one = df.select(F.lit(name).alias("name"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.agg(*[F.count_if(F.col("name") == n).alias(n) for n in counts])


def _one_row(spark: SparkSession, figures: dict[str, int]) -> DataFrame:
    """Figures, each a long, as a row."""
    return spark.createDataFrame([tuple(figures.values())], ", ".join(f"{n} long" for n in figures))


def spots_sync(tables: Tables, listing: DataFrame, details: DataFrame, run: dict, at: Column) -> Tables:
    """Listed spots that changed, upserted with details, images and raw document; spots that are not listed deactivated if the gate allows.

    listing: content_id, source_modified_time; details: content_id, endpoint, payload; run: region, types and the figures of
    guards.deactivation_reason.
    """
    fresh = normalize.skip_unchanged(listing, tables["spots"])
    parsed = normalize.spots(env.combine_details(details.join(fresh.select("content_id"), "content_id", "left_semi")), at, at)
    core = _only(tables["spots"], parsed["core"].withColumns({"inactive_since": F.lit(None).cast("timestamp"), "source_tour_api": F.lit(True)}))
    spots = mutations.apply_upsert(tables["spots"], core, ["content_id"], {"source_busan_food": "or"}, stamp=at if "updated_at" in tables["spots"].columns else None)
    out = {
        "details": mutations.apply_upsert(tables["details"], _only(tables["details"], parsed["detail"]), ["content_id"]),
        "raw": mutations.apply_upsert(tables["raw"], _only(tables["raw"], parsed["raw"]), ["content_id"]),
        "images": mutations.replace_children(tables["images"], parsed["images"], parsed["core"], "content_id"),
        "rejects": parsed["rejects"],
    }
    marked = mutations.mark_listed(spots, listing)
    missing = mutations.of_run(run["region"], run["types"]) & F.col("_seen").isNull()
    counts = agg.active_and_candidates(marked, (F.col("l_dong_regn_cd") == run["region"]) & F.col("content_type_id").isin(run["types"]), missing)
    figures = counts.select("*", *[F.lit(run[k]).alias(k) for k in ("stopped_by_budget", "complete", "fetched", "failed")])
    reason, _ = guards.decide(figures, guards.deactivation_reason({c: F.col(c) for c in figures.columns}))
    if reason is None:
        after, out["deactivated"] = mutations.deactivate(marked, missing, at)
        spots = after.drop("_seen")
    return out | {"spots": spots, "metrics": figures.withColumn("deactivation_skip_reason", F.lit(reason).cast("string"))}


def spots_sync_pages(tables: Tables, pages: DataFrame, details: DataFrame, run: dict, at: Column, page_rows: int = 100) -> Tables:
    """spots_sync from landed list pages (content_type_id, page, payload); run: region, types, stopped_by_budget.

    Items without id are rejects and counted; the run is complete if every type reached a page of fewer than page_rows items.
    """
    listing, invalid = normalize.listing(pages)
    sized = env.page_sizes(pages)
    complete = guards.listing_complete(sized, run["types"], page_rows)
    counts = sized.agg(F.coalesce(F.sum("items"), F.lit(0)).alias("fetched")).first()
    skipped = invalid.agg(F.count("*").alias("n")).first()["n"]
    known = run | {"complete": complete.first()["complete"], "fetched": counts["fetched"], "failed": run.get("failed", 0)}
    out = spots_sync(tables, listing, details, known, at)
    return out | {"rejects": out["rejects"].unionByName(invalid), "metrics": out["metrics"].withColumn("skip_invalid_count", F.lit(skipped))}


def courses_sync(tables: Tables, details: DataFrame, at: Column) -> Tables:
    """Courses upserted, their items replaced (spots that do not exist null), raw documents kept."""
    parsed = normalize.courses(env.combine_details(details), at, at)
    items = mutations.existing_or_null(parsed["items"], "matched_spot_id", tables["spots"], "content_id")
    parents = parsed["courses"].select(F.col("content_id").alias("course_content_id"))
    return {
        "courses": mutations.apply_upsert(tables["courses"], _only(tables["courses"], parsed["courses"]), ["content_id"]),
        "course_items": mutations.replace_children(tables["course_items"], items, parents, "course_content_id"),
        "course_raw": mutations.apply_upsert(tables["course_raw"], _only(tables["course_raw"], parsed["raw"]), ["content_id"]),
        "rejects": parsed["rejects"],
        "metrics": _figures(upserted=parsed["courses"], failed=parsed["rejects"]).withColumn("fetched", F.col("upserted") + F.col("failed")),
    }


def congestion_sync(tables: Tables, landed: DataFrame, source: str = "tourapi") -> Tables:
    """Forecasts matched to spots by district and name, upserted; metrics of the run."""
    good, errors = env.split_errors(landed)
    rows, rejects = normalize.forecasts(good, source)
    rows = mutations.require_source(rows, "source", "tourapi")
    names = matching.match_names_in_district(rows, tables["spots"])
    matched = rows.drop("content_id").join(names, ["signgu_cd", "raw_tats_name"], "left")
    figures = matched.agg(F.count("*").alias("fetched"), F.count("*").alias("upserted"), F.count_if(F.col("content_id").isNull()).alias("unmatched")).withColumn("failed", F.lit(0).cast("long"))
    return {"forecast": mutations.upsert_forecasts(tables["forecast"], matched, ["ordinal"]), "rejects": rejects, "errors": errors, "metrics": agg.congestion_metrics(figures.withColumn("run", F.lit(1)), ["run"])}


def cache_refresh(tables: Tables, last_run: DataFrame, as_of: Column, at: Column) -> Tables:
    """Today's and the next days' rates on spots, if the last sync was sound."""
    reason, _ = guards.decide(last_run, guards.cache_reason({c: F.col(c) for c in last_run.columns}))
    if reason is not None:
        return {"spots": tables["spots"], "metrics": last_run.withColumn("cache_skip_reason", F.lit(reason))}
    rates = agg.congestion_rates(tables["forecast"], as_of)
    return {"spots": mutations.update_congestion(tables["spots"], rates, at), "metrics": last_run.withColumn("cache_skip_reason", F.lit(None).cast("string"))}


def congestion_purge(tables: Tables, as_of: Column, days: int = 7) -> Tables:
    """Forecasts of the last days kept."""
    kept = mutations.purge_before(tables["forecast"], as_of, days)
    figures = _figures(fetched=tables["forecast"], upserted=kept)
    return {"forecast": kept, "metrics": figures.select("*", (F.col("fetched") - F.col("upserted")).alias("purged_count"))}


def food_rows(landed: DataFrame) -> DataFrame:
    """Landed payloads with fetched_at and page as source rows (row, fetched_at, page, ordinal)."""
    landed = landed if "page" in landed.columns else landed.withColumn("page", F.lit(0))
    return env.flexible_items(landed).select(env.item_map(F.col("item")).alias("row"), "fetched_at", "page", "ordinal")


def food_sync(tables: Tables, rows: DataFrame, flavour: str, keep_non_null: bool = False) -> Tables:
    """Source rows of one flavour into places, sources, menus and observations; blocked places are left out.

    Serves the store, menu, guide, file-service and CSV jobs. Rows count one after the other: of rows of one place, or of one
    menu, the last counts; every price is an observation. A known place is overwritten, nulls included, unless keep_non_null.
    """
    parsed = normalize.food_rows(stored(headers.as_cells(rows), "food-rows"), flavour)
    named = F.col("name").isNotNull()
    counts = {"fetched": F.count("*"), "upserted": F.count_if(named & ~F.col("_blocked")), "failed": F.count_if(~named), "skipped_keyword_count": F.count_if(named & F.col("_blocked"))}
    kept, figures = counted(parsed, "food-places", counts, named & ~F.col("_blocked"))  # the parse is written, and counted, once
    ids = stored(normalize.place_ids(kept, tables["sources"]), "food-place-ids")
    known = kept.drop("_label", "_blocked").join(ids, ["source", "external_id"], "left")
    key, order = ["source", "external_id"], normalize.PLACE_ORDER
    menus = known.select("food_place_id", F.col("menu_source").alias("source"), "source_type", *order, F.inline("menus"))
    observed = menus.filter("price is not null").select("food_place_id", "menu_name", F.col("price").alias("observed_price"), "source", "source_type", F.col("fetched_at").alias("observed_at"))
    policy = {}
    if keep_non_null:
        policy = {c: "keep_non_null" for c in tables["places"].columns if c != "id"}
        own = [c for c in known.columns if c not in (*key, "menus", "row", "food_place_id")]
        later = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c)
        place = known.groupBy(*key, "food_place_id").agg(*[later(c) for c in own])
    else:
        place = mutations.last_write(known, key, order)
    sources = mutations.last_write(known, key, order).withColumn("raw_json", F.to_json("row"))
    return {
        "places": mutations.apply_upsert(tables["places"], _only(tables["places"], place.withColumn("id", F.col("food_place_id"))), ["id"], policy),
        "sources": mutations.apply_upsert(tables["sources"], _only(tables["sources"], sources), key),
        "menus": mutations.apply_upsert(tables["menus"], _only(tables["menus"], mutations.last_write(menus, ["food_place_id", "menu_name", "source"], order)), ["food_place_id", "menu_name", "source"]),
        "observations": mutations.append(tables["observations"], observed),
        "rejects": normalize.nameless(parsed),
        "metrics": _one_row(tables["sources"].sparkSession, figures),
    }


def file_rows(csv: DataFrame, at: Column) -> DataFrame:
    """Rows of read_csv_rows with their file name among the headers, in row order (CSV import)."""
    own = F.array_contains("headers", "_source_file")  # a file that has such a column keeps it
    named = [F.when(own, F.col(c)).otherwise(F.array_append(c, value)).alias(c) for c, value in (("headers", F.lit("_source_file")), ("cells", F.col("source_file")))]
    return csv.select(*named, at.alias("fetched_at"), F.lit(0).alias("page"), F.col("row_number").alias("ordinal"))


def store_enrich(tables: Tables) -> Tables:
    """Gaps of menu places filled from the newest store of their name."""
    kinds = tables["sources"].select(F.col("food_place_id").alias("id"), "source").distinct()
    places = tables["places"]
    menu, store = (places.join(kinds.filter(F.col("source") == s).select("id"), "id", "left_semi") for s in ("good_price_menu", "good_price_store"))
    enriched = agg.enrich(menu, store)
    return {"places": mutations.set_columns(places, enriched, "id", ["address", "tel", "source_region", "map_x", "map_y"]), "metrics": agg.enrich_counters(menu, store)}


def spot_match(tables: Tables, similarity: Callable, radius: float = RADIUS, rematch_pending: bool = False) -> Tables:
    """Rule matches of all open places."""
    decided, counters = matching.run_matching(tables["places"], tables["spots"], tables["matches"], similarity, radius, rematch_pending)
    return {"matches": mutations.write_matches(tables["matches"], decided), "metrics": counters}


def price_summary_refresh(tables: Tables, prune: bool = False) -> Tables:
    """Price summary of every matched spot, one aggregate for upsert and prune."""
    fresh = agg.spot_price_summary(tables["menus"], tables["matches"])
    merged = mutations.apply_upsert(tables["summary"], fresh, ["spot_content_id"])
    return {"summary": mutations.prune(merged, fresh, "spot_content_id") if prune else merged, "metrics": _figures(upserted=fresh)}


def place_geocode(tables: Tables, responses: DataFrame, limit: int | None = None) -> Tables:
    """Coordinates of addressed places from landed geocoder responses."""
    results = geocode.resolve_addresses(geocode.geocode_requests(normalize.work_list(tables["places"], "coordinates", limit)), responses)
    found = results.filter("outcome = 'resolved'")
    return {"places": mutations.set_columns(tables["places"], found, "id", ["map_x", "map_y"]), "metrics": agg.outcome_counters(results)}


def address_inference(tables: Tables, keyword: DataFrame, answers: DataFrame, responses: DataFrame, similarity: Callable, limit: int | None = None) -> Tables:
    """Location of places without one: from keyword responses (query, payload), else from model answers (id, raw) that the geocoder confirms."""
    targets = normalize.work_list(tables["places"], "location", limit)
    asked = geocode.keyword_requests(targets).join(targets.select("id", "name", "tel"), "id")
    found = geocode.best_documents(asked.join(env.keyword_documents(keyword), "query"), similarity).select("id", "address", F.col("x").alias("map_x"), F.col("y").alias("map_y"))
    open_ = targets.join(found.select("id"), "id", "left_anti")
    inferred = geocode.accept_inferences(geocode.parse_inferences(answers).join(open_.select("id"), "id", "left_semi"), responses)
    both = found.unionByName(inferred.filter("outcome = 'resolved'").drop("outcome"))
    outcomes = targets.select("id").join(both.select("id", F.lit("resolved").alias("outcome")), "id", "left").join(inferred.select("id", F.col("outcome").alias("_o")), "id", "left")
    results = outcomes.select("id", F.coalesce("outcome", "_o", F.lit("failed")).alias("outcome"))
    return {"places": mutations.set_columns(tables["places"], both, "id", ["address", "map_x", "map_y"]), "requests": geocode.inference_requests(open_, tables["menus"]), "metrics": agg.outcome_counters(results)}


def classification_backfill(tables: Tables, landed: DataFrame) -> Tables:
    """New classification triples with their names."""
    found = agg.first_real_name(normalize.classification_codes(landed))
    return {"codes": mutations.insert_absent(tables["codes"], found, ["code1", "code2", "code3"]), "metrics": _figures(fetched=found)}


#: Job names and what runs them.
JOBS = {
    "tourapi_spots_sync": spots_sync_pages,
    "tourapi_courses_sync": courses_sync,
    "tourapi_congestion_sync": congestion_sync,
    "today_concentration_cache_refresh": cache_refresh,
    "congestion_old_purge": congestion_purge,
    "good_price_store_sync": lambda tables, landed: food_sync(tables, food_rows(landed), "store"),
    "good_price_menu_sync": lambda tables, landed: food_sync(tables, food_rows(landed), "menu"),
    "busan_food_sync": lambda tables, landed: food_sync(tables, food_rows(landed), "guide"),
    "good_price_odcloud_sync": lambda tables, landed: food_sync(tables, food_rows(landed), "file"),
    "good_price_file_import": lambda tables, csv, at: food_sync(tables, file_rows(csv, at), "file"),
    "food_place_store_enrich": store_enrich,
    "food_spot_rule_match": spot_match,
    "spot_price_summary_refresh": price_summary_refresh,
    "food_place_geocode": place_geocode,
    "food_place_address_inference": address_inference,
    "classification_backfill": classification_backfill,
}

#: Outputs of a job that are no snapshots of tables.
REPORTS = ("metrics", "rejects", "errors", "deactivated", "requests")


def run_job(spark: SparkSession, root: str, name: str, run_id: int, tables: Tables, *inputs, run_type: str = "manual", dry_run: bool = False, built_on: int | None = None, **options) -> Tables:
    """Run a job, publish its tables under root and log the run there: running, then success with its figures, or failed (MUT-20).

    A dry run does and counts the same, but publishes nothing (MUT-23). A failure is logged and raised again; so is files.Conflict, if one of
    the tables has changed since version `built_on`, the one that `tables` were read from.
    """
    started = datetime.datetime.now(datetime.UTC)
    end = lambda status, figures: runlog.append(spark, root, runlog.end_row(spark, run_id, name, started, datetime.datetime.now(datetime.UTC), status, *[figures.pop(c, None) for c in ("fetched", "upserted", "failed")], figures, run_type))
    runlog.append(spark, root, runlog.start_row(spark, run_id, name, started, run_type))
    try:
        out = JOBS[name](tables, *inputs, **options)
        figures = out["metrics"].first().asDict() | {"dry_run": dry_run}
        if "rejects" in out:
            figures["errors"] = [r.asDict() for r in runlog.error_sample(out["rejects"].withColumn("run", F.lit(run_id)), "run", "label").select("label", "error").collect()]  # at most 50
        if not dry_run:
            files.publish(spark, {n: df for n, df in out.items() if n not in REPORTS}, root, built_on)
    except Exception as error:
        end("failed", {"error_message": str(error)[:300]})
        raise
    end("success", figures)
    return out
