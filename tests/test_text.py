import pytest
from pyspark.sql import functions as F

from harborlight.functions import text as tx


def values(spark, f, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r.out for r in df.select("i", f(F.col("v")).alias("out")).orderBy("i").collect()]


CASES = [
    (tx.blank_to_null, [" a ", "", "  ", "　b\n", None], ["a", None, None, "b", None]),
    (tx.to_double, ["1.5", " 2 ", "x", None], [1.5, 2.0, None, None]),
    (lambda c: tx.to_double(c, commas=True), ["1,234.5", "12,34"], [1234.5, 1234.0]),
    (tx.yes_no, ["Y", "yes", "가능", "O", "n", "불가능", "무", "?", "", None], [True, True, True, True, False, False, False, None, None, None]),
    (tx.parse_price, ["200000~300000", "7,000원", "12,34", "6500", "1 000", "무료", "", None], [200000, 7000, None, 6500, 1000, None, None, None]),
    (tx.squeeze, ["051 000\t0001", None], ["0510000001", None]),
    (tx.category_code, ["한식", "중국 요리", "초밥집", "경양식", "커피", "이미용업", "세탁업", "숙박", "음식점", "서점", None], ["food_korean", "food_chinese", "food_japanese", "food_western", "food_cafe", "beauty", "bath", "lodging", "food_other", "other", None]),
    (tx.is_food, [None, "미용 음식", "식당", "서점"], [True, False, True, False]),
    (tx.digits_as_int, ["3시간 30분", "없음", None], [330, None, None]),
    (tx.duration_minutes, ["3시간 30분", "2시간", "45분", "하루"], [210, 120, 45, None]),
    (tx.match_name, ["가 나(본점) [2호]!", "A-b_1", None], ["가나", "Ab_1", ""]),
    (tx.match_address, ["부산광역시  해운대구 1", "전라북도 전주", None], ["부산해운대구1", "전북전주", ""]),
    (tx.match_phone, ["051-123-4567", None], ["0511234567", ""]),
    (tx.attraction_name, ["대각사 (부산)", "해운대 해수욕장"], ["대각사", "해운대해수욕장"]),
    (tx.mentions_city, ["부 산 시", "서울", None], [True, False, False]),
]


@pytest.mark.parametrize(("function", "inputs", "expected"), CASES)
def test_normalisers(spark, function, inputs, expected):
    assert values(spark, function, inputs) == expected


def test_hash_ignores_outer_space(spark):
    a, b, c = values(spark, tx.text_hash, ["x y", "\n x y　", "  "])
    assert a == b and len(a) == 64 and c is None


def test_kst(spark):
    out = values(spark, lambda c: F.date_format(tx.kst_timestamp(c), "yyyy-MM-dd HH:mm"), ["20240101080000", "20240230000000", "2024", "2024010108000x", None])
    assert out == ["2023-12-31 23:00", None, None, None, None]


def test_distance_text(spark):
    assert [None if v is None else float(v) for v in values(spark, tx.km, ["약 14.2Km", "1.2.3", "가까움"])] == [14.2, None, None]


@pytest.mark.parametrize(("rate", "level"), [(0.0, 1), (19.99, 1), (20.0, 2), (39.99, 2), (40.0, 3), (59.9, 3), (60.0, 4), (79.9, 4), (80.0, 5), (100.0, 5)])
def test_levels(spark, rate, level):
    assert spark.range(1).select(tx.congestion_level(F.lit(rate))).first()[0] == level


def test_geocode_query(spark):
    inputs = ["(48123) 부산광역시 해운대구 우동 1, 1~2층(우동)", "해운대구 우동 1", "부산 해운대구 우동 1", "부산 중구 대청로 12부산 중구 동광동 5", "부산광역시 중구 5", " ", None]
    assert values(spark, tx.geocode_query, inputs) == ["부산광역시 해운대구 우동 1", "부산광역시 해운대구 우동 1", "부산광역시 해운대구 우동 1", "부산광역시 중구 대청로 12", "부산광역시 중구 5", None, None]


def test_keyword_queries(spark):
    df = spark.createDataFrame([("가게", "중구"), ("가게", None), ("가게", "")], "name string, region string")
    assert [r.q for r in df.select(tx.keyword_queries(F.col("name"), F.col("region")).alias("q")).collect()] == [["부산 중구 가게", "부산 가게"], ["부산 가게"], ["부산 가게"]]


def test_codes_of_districts(spark):
    df = spark.createDataFrame([("26110", "26"), ("110", "26")], "code string, area string")
    assert [r[0] for r in df.select(tx.short_district(F.col("code"), F.col("area"))).collect()] == ["110", "110"]
