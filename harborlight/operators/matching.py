"""Places and spots: work list, spatial candidates, scores, decisions, and counters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlight.functions import similarity as sim
from harborlight.functions.spatial import band, cell, metres, span
from harborlight.functions.text import match_address, match_name

#: Categories that are not matched.
NOT_MATCHED = ("beauty", "bath", "lodging")
NEAREST = 30
#: Least reach of the nearest search, metres.
FINEST = 25.0
#: Rows of one point that are paired together.
GATHERED = 256


def match_targets(places: DataFrame, matches: DataFrame, rematch_pending: bool = False) -> DataFrame:
    """Places to match: active, located, of a matched category (a null category is not one), without manual or model match, and without any match, or (rematch_pending) with a pending rule match (FLT-4, JN-5)."""
    firm = F.bool_or(F.col("match_method").isin("manual", "llm"))
    pending = F.bool_or((F.col("match_method") == "rule") & (F.col("match_status") == "pending"))
    flags = matches.groupBy("food_place_id").agg(firm.alias("_firm"), pending.alias("_pending")).withColumn("_any", F.lit(True))
    joined = places.join(flags, F.col("id") == F.col("food_place_id"), "left")
    own = F.col("is_active") & F.col("map_x").isNotNull() & F.col("map_y").isNotNull() & ~F.col("normalized_category").isin(*NOT_MATCHED)
    free = F.col("_any").isNull() | (F.col("_pending") & ~F.col("_firm") if rematch_pending else F.lit(False))
    return joined.filter(own & free).select(places.columns)


def gathered(rows: DataFrame, x: str, y: str, point: tuple[str, str], name: str, most: int = GATHERED) -> DataFrame:
    """Up to `most` rows of one point as an array `name` beside it; rows without a point are left out."""
    nth = F.row_number().over(Window.partitionBy(x, y).orderBy(F.lit(0)))
    parts = rows.dropna(subset=[x, y]).withColumn("_part", F.floor((nth - 1) / most))
    return parts.groupBy(F.col(x).alias(point[0]), F.col(y).alias(point[1]), "_part").agg(F.collect_list(F.struct(*rows.columns)).alias(name)).drop("_part")


def within(left: DataFrame, right: DataFrame, radius: float, digits: int | None = None) -> DataFrame:
    """Pairs of rows at most `radius` metres apart, with distance_m (JN-4), rounded afterwards if `digits` are given.

    left has map_x, map_y; right has spot_x, spot_y. Cells are at least a radius wide at any latitude, so the neighbours of a
    cell hold all partners: right goes to three cells of its latitude band and of both neighbours, by the longitude step of
    each, and the join is on equality. No pair is met twice. Rows of one point go together, some hundred at a time, and are paired
    after the distance of their points is known.
    """
    near = in_cell(gathered(left, "map_x", "map_y", ("_x", "_y"), "_rows"), radius, x="_x", y="_y")
    far = around(spread(gathered(right, "spot_x", "spot_y", ("_sx", "_sy"), "_partners")), "_sx", "_sy", radius)
    # Merged, as sizes estimated from compressed keys would have arrays broadcast.
    pairs = spread(near, "_cx", "_cy").join(far.hint("merge"), ["_cx", "_cy"]).withColumn("distance_m", metres(F.col("_x"), F.col("_y"), F.col("_sx"), F.col("_sy"))).filter(F.col("distance_m") <= radius)
    if digits is not None:
        pairs = pairs.withColumn("distance_m", F.round("distance_m", digits))
    return pairs.select(F.inline("_rows"), "_partners", "distance_m").select(*left.columns, F.inline("_partners"), "distance_m")


def restaurant_spots(spots: DataFrame) -> DataFrame:
    """Active restaurants as match candidates."""
    rows = spots.filter("is_active and content_type_id = '39'")
    return rows.select(F.col("content_id").alias("spot_content_id"), F.col("title").alias("spot_title"), F.col("tel").alias("spot_tel"), F.col("address").alias("spot_address"), F.col("map_x").alias("spot_x"), F.col("map_y").alias("spot_y"))


def nearest(pairs: DataFrame, key: str | list[str] = "id", n: int = NEAREST) -> DataFrame:
    """The n nearest candidates of each place, ties by spot id (WIN-4)."""
    order = Window.partitionBy(key).orderBy("distance_m", "spot_content_id")
    return pairs.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def around(rows: DataFrame, x: str, y: str, size: float | Column, steps: int = 1, reach: int | None = None) -> DataFrame:
    """rows copied to the cells (_cx, _cy) up to `steps` from their own; each band counts by its own longitude step."""
    by = F.array(*[F.lit(i) for i in range(-steps, steps + 1)])
    banded = rows.select("*", F.explode(by).alias("_cy")).withColumn("_cy", band(F.col(y), size) + F.col("_cy"))
    return banded.select("*", F.explode(by).alias("_cx")).withColumn("_cx", cell(F.col(x), F.col("_cy"), size, reach or steps) + F.col("_cx"))


def in_cell(rows: DataFrame, size: float | Column, reach: int = 1, x: str = "map_x", y: str = "map_y") -> DataFrame:
    """rows with the cell (_cx, _cy) of their point."""
    return rows.withColumn("_cy", band(F.col(y), size)).withColumn("_cx", cell(F.col(x), F.col("_cy"), size, reach))


def located(rows: DataFrame, x: str, y: str, on: list[str]) -> DataFrame:
    """Rows with a point and a value in each column of `on`."""
    return rows.dropna(subset=[x, y, *on])


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """rows over all cores, by a number of partitions that adaptive execution keeps: few bytes become many pairs."""
    spark = rows.sparkSession
    return rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *by)


def apart() -> Column:
    return metres(F.col("map_x"), F.col("map_y"), F.col("spot_x"), F.col("spot_y"))


def nearest_within(left: DataFrame, right: DataFrame, radius: float, n: int = NEAREST, on: tuple[str, ...] = (), key: str | None = "id") -> DataFrame:
    """The n nearest partners within the radius of each row of left, equal in the columns `on`, ties by spot id (WIN-4).

    Found once per point of left. A point looks as far as the least of radius, radius / 2, ... whose block of nine cells around it is known to
    hold n partners and to lie within that reach, so it meets few more than n of them in a dense area as in a thin one. Partners of one
    point count together, and only the n least ids of a point can be among the nearest. Where values of `key` repeat, the n nearest
    are those of all rows of a value; None: of each row.
    """
    on, at, partners = list(on), ["map_x", "map_y", *on], ["spot_x", "spot_y", *on]
    columns = [c for c in right.columns if c not in on]
    reaches = [radius]
    while reaches[-1] / 2 >= FINEST:
        reaches.append(reaches[-1] / 2)
    tries = F.array(*[F.lit(r) for r in reaches])
    reach = F.col("_reach")

    least = located(right, "spot_x", "spot_y", on).withColumn("_n", F.row_number().over(Window.partitionBy(*partners).orderBy("spot_content_id"))).filter(F.col("_n") <= n)
    spots = spread(least.groupBy(*partners).agg(F.count("*").alias("_m")))
    lists = least.groupBy(*partners).agg(F.collect_list(F.struct(*columns)).alias("_rows"))

    cells = ["_reach", "_cx", "_cy", *on]
    full = around(spots.select("*", F.explode(tries).alias("_reach")).filter(reach < radius), "spot_x", "spot_y", reach / 3).groupBy(*cells).agg(F.sum("_m").alias("_m")).filter(F.col("_m") >= n).drop("_m")
    points = located(left, "map_x", "map_y", on).select(*at).distinct()
    tried = in_cell(points.select("*", F.explode(tries).alias("_reach")), reach / 3).filter((reach == radius) | (span(F.col("_cy"), reach / 3) <= reach))
    chosen = tried.join(full.withColumn("_full", F.lit(True)), cells, "left").filter((reach == radius) | F.col("_full")).groupBy(*at).agg(F.min("_reach").alias("_reach"))

    used = chosen.select("_reach").distinct()
    far = around(spots.crossJoin(F.broadcast(used)), "spot_x", "spot_y", reach)
    pairs = spread(in_cell(chosen, reach), *cells).join(far, cells).withColumn("distance_m", apart()).filter(F.col("distance_m") <= reach)
    one = Window.partitionBy(*cells, "map_x", "map_y")
    counted = pairs.withColumn("_sum", F.sum("_m").over(one.orderBy("distance_m").rowsBetween(Window.unboundedPreceding, 0)))
    enough = counted.withColumn("_enough", F.min(F.when(F.col("_sum") >= n, F.col("distance_m"))).over(one)).filter(F.col("_enough").isNull() | (F.col("distance_m") <= F.col("_enough")))
    rows = enough.select(*at, "spot_x", "spot_y", "distance_m").join(lists, partners).select(*at, "distance_m", F.inline("_rows"))
    return _opened(left, nearest(rows, at, n), at, [*columns, "distance_m"], key, ["distance_m", "spot_content_id"], n)


def first_within(left: DataFrame, right: DataFrame, radius: float, n: int = 1, on: tuple[str, ...] = (), key: str | None = "id") -> DataFrame:
    """The n partners of least spot id within the radius of each row of left, equal in the columns `on`, with distance_m; `key` as in nearest_within.

    Cells are a third of the radius wide, so the nine around a point lie within it: partners beyond the n-th id of these nine are
    none of the first n, and of the others few are left for each cell.
    """
    on, at = list(on), ["map_x", "map_y", *on]
    size, columns, cells = radius / 3, [c for c in right.columns if c not in on], ["_cx", "_cy", *on]
    spots = spread(located(right, "spot_x", "spot_y", on))
    points = in_cell(located(left, "map_x", "map_y", on).select(*at).distinct(), size, 3)
    block = around(spots.select("spot_x", "spot_y", "spot_content_id", *on), "spot_x", "spot_y", size, 1, 3)
    last = block.withColumn("_n", F.row_number().over(Window.partitionBy(*cells).orderBy("spot_content_id"))).filter(F.col("_n") == n)
    sure = last.filter(span(F.col("_cy"), size, 3) <= radius).select(*cells, F.col("spot_content_id").alias("_last"))
    asked = points.select(*cells).distinct().join(sure, cells, "left")
    some = around(spots, "spot_x", "spot_y", size, 3).join(asked, cells).filter(F.col("_last").isNull() | (F.col("spot_content_id") <= F.col("_last"))).drop("_last")
    pairs = spread(points, *cells).join(some, cells).withColumn("distance_m", apart()).filter(F.col("distance_m") <= radius)
    ranked = pairs.withColumn("_n", F.row_number().over(Window.partitionBy(*cells, "map_x", "map_y").orderBy("spot_content_id"))).filter(F.col("_n") <= n)
    return _opened(left, ranked, at, [*columns, "distance_m"], key, ["spot_content_id"], n)


def _opened(left: DataFrame, found: DataFrame, at: list[str], columns: list[str], key: str | None, order: list[str], n: int) -> DataFrame:
    """Rows of left with the partners found for their point."""
    lists = found.groupBy(*at).agg(F.collect_list(F.struct(*columns)).alias("_found"))
    rows = left.join(lists, at).select(*left.columns, F.inline("_found"))
    if key is None or left.groupBy(key).count().filter("count > 1").isEmpty():
        return rows
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("_n") <= n).drop("_n")


def semi_near(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """Rows of left with any partner within the radius (JN-12)."""
    ids = within(left, right, radius).select("id").distinct()
    return left.join(ids, "id", "left_semi")


def score_candidates(pairs: DataFrame, similarity: Callable[[Column, Column], Column]) -> DataFrame:
    """pairs with tel_score, name_score, address_score and match_score."""
    scored = pairs.withColumns({
        "tel_score": sim.phone_score(F.col("tel"), F.col("spot_tel")),
        "name_score": similarity(match_name(F.col("name")), match_name(F.col("spot_title"))),
        "address_score": similarity(match_address(F.col("address")), match_address(F.col("spot_address"))),
    })
    return scored.withColumn("match_score", sim.match_score(F.col("tel_score"), F.col("name_score"), F.col("address_score"), sim.distance_score(F.col("distance_m"))))


def contenders(places: DataFrame, spots: DataFrame, radius: float) -> DataFrame:
    """Pairs within the radius that hold the two best of each place, where only telephone, equal names and distance tell scores apart.

    Of the spots with a pair's telephone or name hits, or more of them, a nearer one scores no less. So a place's two best are
    among its two nearest of all spots, of those with its telephone, with its name, or with both; `_kind` says which hits a pair has.
    """
    tel, name = F.col("_tel"), F.col("_name")
    keys = (F.lit(""), tel, name, F.concat(tel, F.lit("\n"), name))
    kinds = F.array(*[F.struct(F.lit(i).alias("_kind"), k.alias("_key")) for i, k in enumerate(keys)])
    sides = [rows.withColumns({"_tel": sim.phone_key(F.col(t)), "_name": F.col(n)}).select(*rows.columns, F.inline(kinds)) for rows, t, n in ((places, "tel", "name"), (spots, "spot_tel", "spot_title"))]
    pairs = nearest_within(*sides, radius, 2, on=("_kind", "_key"), key=None)
    hits = F.when(sim.phone_score(F.col("tel"), F.col("spot_tel")) > 0, 1).otherwise(0) + F.when(F.col("name") == F.col("spot_title"), 2).otherwise(0)
    return pairs.filter(F.col("_kind") == hits).drop("_kind", "_key")


def pick_best(scored: DataFrame, key: str = "id") -> DataFrame:
    """Best candidate of each place with its final status (WIN-5, SIM-8, SIM-9); ties keep distance order."""
    order = Window.partitionBy(key).orderBy(F.col("match_score").desc(), "distance_m", "spot_content_id")
    ranked = scored.withColumns({"_n": F.row_number().over(order), "second_score": F.lead("match_score").over(order)}).filter("_n = 1")
    status = sim.final_status(F.col("match_score"), F.col("second_score"), F.col("tel_score"), F.col("name_score"))
    return ranked.select(F.col(key).alias("food_place_id"), "spot_content_id", "match_score", "second_score", status.alias("match_status"))


def run_matching(places: DataFrame, spots: DataFrame, matches: DataFrame, similarity: Callable[[Column, Column], Column], radius: float = sim.RADIUS, rematch_pending: bool = False) -> tuple[DataFrame, DataFrame]:
    """(one decision per place that has a candidate, run counters) (SIM-10, AGG-4)."""
    targets = match_targets(places, matches, rematch_pending)
    decided = pick_best(score_candidates(nearest(within(targets, restaurant_spots(spots), radius)), similarity))
    return decided, match_counters(targets, decided)


def match_counters(targets: DataFrame, decided: DataFrame) -> DataFrame:
    """scanned, matched, pending, separate, no_candidate (AGG-4)."""
    status = decided.select(F.col("food_place_id").alias("id"), "match_status")
    joined = targets.select("id").join(status, "id", "left")
    each = [F.count_if(F.col("match_status") == s).alias(s) for s in ("matched", "pending", "separate")]
    return joined.agg(F.count("*").alias("scanned"), *each, F.count_if(F.col("match_status").isNull()).alias("no_candidate"))


def match_names_in_district(names: DataFrame, spots: DataFrame) -> DataFrame:
    """Distinct (signgu_cd, raw_tats_name) with content_id of the spot of that name, the least if several (JN-6, LIM-3, AGG-12)."""
    from harborlight.functions.text import attraction_name

    by_name = spots.filter("is_active").groupBy(F.col("l_dong_signgu_cd").alias("signgu_cd"), attraction_name(F.col("title")).alias("_name")).agg(F.min("content_id").alias("content_id"))
    distinct = names.select("signgu_cd", "raw_tats_name").distinct().withColumn("_name", attraction_name(F.col("raw_tats_name")))
    return distinct.join(by_name, ["signgu_cd", "_name"], "left").drop("_name")
