import math
import random

import pytest
from pyspark.sql import functions as F

from harborlight.functions import similarity as sim
from harborlight.functions.spatial import in_box, metres
from harborlight.operators import matching

PLACES = "id long, name string, tel string, address string, map_x double, map_y double, is_active boolean, normalized_category string"
SPOTS = "content_id string, content_type_id string, title string, tel string, address string, map_x double, map_y double, is_active boolean"
MATCHES = "food_place_id long, spot_content_id string, match_status string, match_method string, match_score double"
LON = 1 / (111320 * math.cos(math.radians(35.1)))


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [("", "", 1.0), ("a", "", 0.0), ("abcdefgh", "abcdefgh", 1.0), ("abcdefgh", "bcadefgh", 0.9375), ("가나", "가다", 0.7), ("abc", "xyz", 0.0), ("martha", "marhta", 0.961111)],
)
def test_name_similarity(a, b, expected):
    got = sim.name_similarity(a, b)
    if (a, b) == ("가나", "가다"):
        expected = 2 / 3 + 0.1 / 3
    assert got == pytest.approx(expected, abs=1e-5)


def test_similarity_udf_takes_nulls(spark):
    df = spark.createDataFrame([("ab", "ab"), (None, None), ("ab", None)], "a string, b string")
    assert [r[0] for r in df.select(sim.similarity_udf(spark)(F.col("a"), F.col("b"))).collect()] == [1.0, 1.0, 0.0]


def test_scores(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(sim.distance_score(F.lit(50.0))) == 0.75
    assert get(sim.distance_score(F.lit(None).cast("double"))) == 0.0 and get(sim.distance_score(F.lit(200.0))) == 0.0
    assert get(sim.phone_score(F.lit("051-123-4567"), F.lit("0511234567"))) == 1.0
    assert get(sim.phone_score(F.lit("+82 51 123 45678"), F.lit("051-123-45678"))) == 1.0
    assert get(sim.phone_score(F.lit("12345"), F.lit("12345"))) == 0.0
    assert [get(sim.status_of(F.lit(s))) for s in (0.85, 0.84, 0.65, 0.64)] == ["matched", "pending", "pending", "separate"]
    assert get(sim.lower_if_ambiguous(F.lit("matched"), F.lit(0.87), F.lit(0.79))) == "pending"
    assert get(sim.lower_if_ambiguous(F.lit("pending"), F.lit(0.7), F.lit(0.69))) == "separate"
    assert get(sim.lower_if_ambiguous(F.lit("matched"), F.lit(0.9), F.lit(None).cast("double"))) == "matched"
    assert get(sim.final_status(F.lit(0.9), F.lit(None).cast("double"), F.lit(0.0), F.lit(0.9))) == "pending"
    assert get(in_box(F.lit(129.0), F.lit(35.1))) and not get(in_box(F.lit(127.0), F.lit(37.5)))


def test_metres(spark):
    d = spark.range(1).select(metres(F.lit(129.0), F.lit(35.1), F.lit(129.0), F.lit(35.1018))).first()[0]
    assert d == pytest.approx(199.7, abs=0.3)


def test_within_equals_all_pairs(spark):
    places = spark.range(60).select(F.col("id"), (129.0 + (F.col("id") * 37 % 60) / 20000).alias("map_x"), (35.1 + (F.col("id") * 53 % 60) / 20000).alias("map_y"))
    spots = places.select(F.col("id").cast("string").alias("spot_content_id"), F.col("map_y").alias("k"), (F.col("map_x") + 0.0003).alias("spot_x"), F.col("map_y").alias("spot_y")).drop("k")
    got = matching.within(places, spots, 200.0).select("id", "spot_content_id").collect()
    every = places.crossJoin(spots).filter(metres(F.col("map_x"), F.col("map_y"), F.col("spot_x"), F.col("spot_y")) <= 200).select("id", "spot_content_id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, every)) and got


@pytest.mark.parametrize("latitude", [0.0, 38.0, 60.0, -60.0, 89.9])
def test_within_at_any_latitude(spark, latitude):
    import random

    rng = random.Random(6)
    wide = 0.01 / max(math.cos(math.radians(latitude)), 0.002)
    draw = lambda: (129 + rng.uniform(0, wide), latitude + rng.uniform(0, 0.01))
    places = spark.createDataFrame([(i, *draw()) for i in range(200)], "id long, map_x double, map_y double")
    spots = spark.createDataFrame([(str(i), *draw()) for i in range(200)], "spot_content_id string, spot_x double, spot_y double")
    got = matching.within(places, spots, 200.0).select("id", "spot_content_id").collect()
    far = metres(F.col("map_x"), F.col("map_y"), F.col("spot_x"), F.col("spot_y"))
    want = places.crossJoin(spots).filter(far <= 200.0).select("id", "spot_content_id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 100



def run(spark, places, spots, matches=()):
    return matching.run_matching(spark.createDataFrame(places, PLACES), spark.createDataFrame(spots, SPOTS), spark.createDataFrame(list(matches), MATCHES), sim.similarity_udf(spark))


def test_run_matching(spark):
    place = lambda i, name, tel, x, cat="food_korean", on=True: (i, name, tel, "부산 중구 1", x, 35.1, on, cat)
    places = [
        place(1, "가나식당", "051-111-2222", 129.0),
        place(2, "쌍둥이", "051-333-4444", 129.1),
        place(3, "다른집", None, 129.2),
        place(4, "외딴집", None, 129.3),
        place(5, "범주없음", "051-111-2222", 129.0, None),
        place(6, "이발소", None, 129.0, "beauty"),
        place(7, "쉬는집", None, 129.0, on=False),
    ]
    spots = [
        ("a", "39", "가나식당", "0511112222", "부산광역시 중구 1", 129.0 + 20 * LON, 35.1, True),
        ("b", "39", "쌍둥이", "0513334444", "부산 중구 1", 129.1 + 10 * LON, 35.1, True),
        ("c", "39", "쌍둥이", "0513334444", "부산 중구 1", 129.1 - 12 * LON, 35.1, True),
        ("d", "39", "전혀아님", None, "서울", 129.2, 35.1, True),
        ("e", "12", "외딴집", None, "부산", 129.3, 35.1, True),
        ("f", "39", "외딴집", None, "부산", 129.3, 35.1, False),
    ]
    decided, counters = run(spark, places, spots)
    got = {r.food_place_id: (r.spot_content_id, r.match_status) for r in decided.collect()}
    assert got == {1: ("a", "matched"), 2: ("b", "pending"), 3: ("d", "separate")}
    assert counters.first().asDict() == {"scanned": 4, "matched": 1, "pending": 1, "separate": 1, "no_candidate": 1}


def test_match_targets_rules(spark):
    places = spark.createDataFrame([(i, f"n{i}", None, None, 129.0, 35.1, True, "food_korean") for i in range(1, 6)], PLACES)
    matches = spark.createDataFrame([(1, "s", "pending", "rule", 0.7), (2, "s", "matched", "manual", 1.0), (3, "s", "matched", "rule", 0.9), (4, "s", "pending", "rule", 0.7), (4, "t", "matched", "llm", 0.9)], MATCHES)
    ids = lambda again: sorted(r.id for r in matching.match_targets(places, matches, again).collect())
    assert ids(False) == [5] and ids(True) == [1, 5]


def test_no_rows(spark):
    decided, counters = run(spark, [], [])
    assert decided.count() == 0 and counters.first().scanned == 0


def test_nearest_within_is_exact_in_dense_and_thin_areas(spark):
    """Places with enough partners near by, and places that have to look as far as the radius."""
    rng = random.Random(5)
    near = [(f"s{i}", 129.0 + rng.random() / 100, 35.1 + rng.random() / 100) for i in range(120)] + [(f"t{i}", 129.2 + rng.random() / 20, 35.1 + rng.random() / 20) for i in range(30)]
    spots = spark.createDataFrame(near, "spot_content_id string, spot_x double, spot_y double")
    places = [(i, 129.0 + rng.random() / 100, 35.1 + rng.random() / 100) for i in range(40)] + [(100 + i, 129.2 + rng.random() / 20, 35.1 + rng.random() / 20) for i in range(20)] + [(999, None, 35.1)]
    left = spark.createDataFrame(places, "id long, map_x double, map_y double")
    got = matching.nearest_within(left, spots, 2000.0, n=10).collect()
    want = matching.nearest(matching.within(left, spots, 2000.0), n=10).collect()
    rows = lambda found: sorted((r.id, r.spot_content_id, round(r.distance_m, 6)) for r in found)
    assert rows(got) == rows(want) and len({r.id for r in got if r.id >= 100}) > 5
