"""Searches within a radius: equal to all pairs, with few pairs made."""

import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from harborlight.functions import similarity as sim
from harborlight.functions import spatial
from harborlight.operators import geocode, matching
from harborlight.plans import catalog


@pytest.fixture
def made(spark, monkeypatch):
    """Counts the pairs whose distance is taken."""
    count = spark.sparkContext.accumulator(0)
    axis, flat = spatial.AXIS, spatial.ECCENTRICITY2

    @F.pandas_udf("double")
    def far(x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series) -> pd.Series:
        count.add(len(x1))
        middle = np.radians((y1 + y2) / 2)
        w = 1 - flat * np.sin(middle) ** 2
        along, across = np.radians(y2 - y1) * (axis * (1 - flat)) / w**1.5, np.radians(x2 - x1) * axis * np.cos(middle) / w**0.5
        return np.sqrt(along**2 + across**2)

    monkeypatch.setattr(matching, "metres", far)
    return count


def town(spark, places, spots, size=0.01, seed=3, latitude=35.1, step=None):
    """Places and spots in a square; with `step` on a grid, so that points and distances repeat."""
    rng = random.Random(seed)
    at = lambda: rng.uniform(0, size) if step is None else step * rng.randrange(int(size / step))
    left = spark.createDataFrame([(i, f"n{i % 7}", 129 + at(), latitude + at()) for i in range(places)], "id long, name string, map_x double, map_y double")
    right = spark.createDataFrame([(str(i), f"n{i % 5}", 129 + at(), latitude + at()) for i in range(spots)], "spot_content_id string, spot_title string, spot_x double, spot_y double")
    return left.repartition(4).localCheckpoint(), right.repartition(4).localCheckpoint()


def every(left, right, radius, by=("distance_m", "spot_content_id"), n=None, same=False):
    """All pairs within the radius by a cross join, or the first n of each id."""
    pairs = left.crossJoin(right).withColumn("distance_m", spatial.metres(F.col("map_x"), F.col("map_y"), F.col("spot_x"), F.col("spot_y"))).filter(F.col("distance_m") <= radius)
    if same:
        pairs = pairs.filter("name = spot_title")
    kept = {}
    for r in sorted(pairs.collect(), key=lambda r: tuple(r[c] for c in by)):
        kept.setdefault(r.id, []).append((r.id, r.spot_content_id, round(r.distance_m, 6)))
    return sorted(row for rows in kept.values() for row in rows[:n])


def rows(found):
    return sorted((r.id, r.spot_content_id, round(r.distance_m, 6)) for r in found.collect())


def test_nearest_makes_few_pairs_in_a_dense_area(spark, made):
    left, right = town(spark, 400, 400)
    got = rows(matching.nearest_within(left, right, 2000.0, n=3))
    assert got == every(left, right, 2000.0, n=3) and len(got) == 1200
    assert made.value < 40_000


def test_nearest_takes_a_shared_point_once(spark, made):
    left = spark.range(300).select("id", F.lit(129.0).alias("map_x"), F.lit(35.1).alias("map_y"))
    right = spark.range(300).select(F.col("id").cast("string").alias("spot_content_id"), F.lit(129.0).alias("spot_x"), F.lit(35.1).alias("spot_y"))
    got = matching.nearest_within(left, right, 2000.0, n=5).collect()
    assert len(got) == 1500 and {r.spot_content_id for r in got} == {"0", "1", "10", "100", "101"}
    assert made.value < 100


@pytest.mark.parametrize(("latitude", "step", "radius"), [(35.1, 0.0005, 500.0), (0.0, 0.0005, 300.0), (-72.0, 0.0005, 400.0), (89.95, 0.0005, 300.0), (60.0, None, 2000.0)])
def test_nearest_with_ties_at_any_latitude(spark, latitude, step, radius):
    left, right = town(spark, 150, 200, latitude=latitude, step=step)
    got = rows(matching.nearest_within(left, right, radius, n=4))
    assert got == every(left, right, radius, n=4) and len(got) > 300


def test_nearest_of_repeated_ids_and_of_equal_names(spark):
    left, right = town(spark, 80, 150, step=0.0005)
    twice = left.withColumn("id", F.col("id") % 40)
    assert rows(matching.nearest_within(twice, right, 500.0, n=4)) == every(twice, right, 500.0, n=4)
    named = right.withColumn("name", F.col("spot_title"))
    assert rows(matching.nearest_within(left, named, 500.0, n=2, on=("name",))) == every(left, right, 500.0, n=2, same=True)


def test_first_by_id_makes_few_pairs_in_a_dense_area(spark, made):
    left, right = town(spark, 300, 1500, size=0.006)
    got = rows(matching.first_within(left, right, 300.0, 3))
    assert got == every(left, right, 300.0, ("spot_content_id",), 3) and len(got) == 900
    assert made.value < 40_000


@pytest.mark.parametrize(("latitude", "step", "radius"), [(35.1, 0.0005, 300.0), (0.0, 0.0005, 200.0), (-72.0, 0.0005, 300.0), (89.95, 0.0005, 300.0), (60.0, None, 900.0)])
def test_first_by_id_at_any_latitude(spark, latitude, step, radius):
    left, right = town(spark, 150, 300, latitude=latitude, step=step)
    got = rows(matching.first_within(left, right, radius, 4))
    assert got == every(left, right, radius, ("spot_content_id",), 4) and len(got) > 300


def test_first_by_id_of_repeated_ids_and_of_equal_names(spark):
    left, right = town(spark, 80, 150, step=0.0005)
    twice = left.withColumn("id", F.col("id") % 40)
    ids = lambda found: [r[:2] for r in found]
    assert ids(rows(matching.first_within(twice, right, 400.0, 3))) == ids(every(twice, right, 400.0, ("spot_content_id",), 3))
    named = right.withColumn("name", F.col("spot_title"))
    assert rows(matching.first_within(left, named, 400.0, 2, on=("name",))) == every(left, right, 400.0, ("spot_content_id",), 2, same=True)


def test_best_documents_compares_no_more_than_it_must(spark):
    """A document with the place's telephone or name ends the comparison of its query and of later ones."""
    asked = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        asked.add(int((a != "").sum()))
        return (a == b).astype("float64").where(a == b, 0.8)

    document = lambda i, q, n, name, phone=None, x=129.0: (i, "가나", "051-111-2222", q, f"q{q}", n, name, phone, x, 35.1, None)
    found = [document(1, 0, n, "다라") for n in range(50)] + [document(1, 0, 7, "다라", "0511112222")] + [document(1, 1, n, "가나") for n in range(50)]
    found += [document(2, 0, 0, "가나", x=120.0), document(2, 0, 1, None), document(2, 1, 3, "마바"), document(2, 1, 2, "사아"), document(2, 2, 1, "가나")]
    schema = "id long, name string, tel string, query_pos int, query string, ordinal int, place_name string, phone string, x double, y double, address string"
    best = geocode.best_documents(spark.createDataFrame(found, schema), alike).collect()
    assert sorted((r.id, r.query, r.score) for r in best) == [(1, "q0", 1.0), (2, "q1", 0.8)]
    assert asked.value <= 4  # two documents, in the filter and in the result


def test_within_takes_a_distance_of_shared_points_once(spark, made, monkeypatch):
    left, right = town(spark, 300, 200, size=0.002, step=0.001)
    got = rows(matching.within(left, right, 120.0))
    assert got == every(left, right, 120.0) and len(got) > 20_000
    assert made.value < 200
    monkeypatch.setattr(matching.gathered, "__defaults__", (7,))
    assert rows(matching.within(left, right, 120.0)) == got
    rounded = matching.within(left, right, 120.0, digits=1).select("id", "spot_content_id", "distance_m")
    assert sorted(map(tuple, rounded.collect())) == [(i, s, round(d, 1)) for i, s, d in got]


TABLES = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
@pytest.mark.parametrize(("name", "most"), [("cheap_restaurants_near_spot", 600_000), ("geocode_best_equal_names", 400_000), ("match_decision", 350_000)])
def test_query_makes_few_pairs(spark, made, name, most):
    """`most` is a fraction of the pairs in neighbouring cells."""
    catalog.QUERIES[name](spark, TABLES).write.format("noop").mode("overwrite").save()
    assert 0 < made.value < most


def test_contenders_hold_the_two_best(spark):
    """Against the scores of all pairs, with telephones of 7, 8 and more digits, equal names, and nulls."""
    left, right = town(spark, 150, 400, step=0.0005)
    tels = F.array(*[F.lit(t) for t in (None, "123-4567", "051-123-4567", "51 123 4567", "02-765-4321", "12345", "0511234567")])
    tel = lambda c, n: F.element_at(tels, (F.col(c).cast("int") % n + 1).cast("int"))
    places, spots = left.withColumns({"tel": tel("id", 7), "name": F.when(F.col("id") % 9 > 0, F.col("name"))}), right.withColumn("spot_tel", tel("spot_content_id", 6))

    def best(pairs):
        scored = pairs.withColumns({"tel_score": sim.phone_score(F.col("tel"), F.col("spot_tel")), "name_score": F.when(F.col("name") == F.col("spot_title"), 1.0).otherwise(0.0)})
        scored = scored.withColumn("match_score", sim.match_score(F.col("tel_score"), F.col("name_score"), F.lit(1.0), sim.distance_score(F.col("distance_m"))))
        return sorted(map(tuple, matching.pick_best(scored).collect()))

    few = matching.contenders(places, spots, 300.0).localCheckpoint()
    assert best(few) == best(matching.within(places, spots, 300.0))
    assert few.groupBy("id").count().agg(F.max("count")).first()[0] <= 8 and few.count() == few.select("id", "spot_content_id").distinct().count()
