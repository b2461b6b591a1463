import datetime
import glob
import json

import pytest
from pyspark.sql import functions as F

from harborlight.functions.similarity import similarity_udf
from harborlight.operators import generators, geocode, normalize
from harborlight.plans import jobs
from harborlight.sources import csv_records, files
from harborlight.sources import envelopes as env

AT = datetime.datetime(2024, 1, 2, 3, 4, 5)


def landed(spark, *payloads):
    return spark.createDataFrame([(p if isinstance(p, str) else json.dumps(p, ensure_ascii=False),) for p in payloads], "payload string").withColumn("fetched_at", F.lit(AT)).withColumn("page", F.lit(1))


def envelope(item):
    return {"response": {"header": {"resultCode": "0000"}, "body": {"items": {"item": item}}}}


def test_list_items(spark):
    df = landed(spark, envelope([{"a": "1"}, {"a": 2}, "skip"]), envelope({"a": "3"}), envelope(None), {"response": {"body": {"items": ""}}}, "not json")
    assert sorted(r.a for r in env.list_items(df).select(F.try_variant_get("item", "$.a", "string").alias("a")).collect()) == ["1", "2", "3"]


def test_flexible_items(spark):
    item = [{"idx": "1"}]
    shapes = [{"items": item}, {"item": item}, {"data": item}, {"body": {"items": item}}, {"response": {"body": {"items": item}}}, {"response": {"body": {"item": item}}}, {"response": {"body": {"data": item}}}, envelope(item), {"items": {"item": item[0]}}, {"data": {"idx": "1"}}]
    assert env.flexible_items(landed(spark, *shapes)).count() == len(shapes)
    assert env.flexible_items(landed(spark, {"items": [], "data": item}, {"x": 1}, "[")).count() == 0


def test_errors(spark):
    xml = " <OpenAPI><returnReasonCode>30</returnReasonCode><returnAuthMsg>BAD KEY</returnAuthMsg><errMsg>SERVICE ERROR</errMsg></OpenAPI>"
    good, bad = env.split_errors(landed(spark, envelope([]), {"resultCode": "22", "resultMsg": "limit"}, xml, "<broken"))
    assert good.count() == 1
    assert sorted((r.result_code, r.message) for r in bad.collect()) == [("22", "limit"), ("30", "BAD KEY: SERVICE ERROR"), ("xml", "")]


def place(spark, row, flavour):
    df = spark.createDataFrame([({k: str(v) for k, v in row.items()},)], "row map<string,string>").withColumn("fetched_at", F.lit(AT))
    good, rejects = normalize.food_places(df, flavour)
    return good.first(), rejects.collect()


def test_wide_file_row(spark):
    p, _ = place(spark, {"시군": "중구", "업종": "한식", "업소명": "가게", "연락처": "051 1", "주소": "부산", "품목1": "김치찌개", "가격1": "7000", "품목2": "된장찌개", "가격2": "6,500원"}, "file")
    assert (p.source, p.normalized_category, p.is_course_food_candidate, p.tel, p.source_region) == ("good_price_file", "food_korean", True, "0511", "중구")
    assert [(m.menu_name, m.price, m.display_order, m.is_representative) for m in p.menus] == [("김치찌개", 7000, 1, True), ("된장찌개", 6500, 2, False)]
    assert p.representative_menu == "김치찌개"


def test_padded_headers_and_range(spark):
    p, _ = place(spark, {"업소명": "가게", "품목1": "a", " 가격1 ": "200000~300000", "품목2": "A", "가격2": "1", "메뉴 3": "c", "가격 3": "12,34"}, "file")
    assert [(m.menu_name, m.price, m.display_order) for m in p.menus] == [("a", 200000, 1), ("c", None, 2)]


def test_store_and_menu_rows(spark):
    p, _ = place(spark, {"idx": "123", "sj": "가게", "cn": "한식", "adres": "부산", "tel": "051-000-1111", "parkngAt": "Y"}, "store")
    assert (p.source, p.external_id, p.parking_available, p.tel, p.menus) == ("good_price_store", "123", True, "051-000-1111", [])
    a, _ = place(spark, {"bsshNm": "Gaege", "itemNm": "국수", "menuPrc": 6000, "crtDt": "1"}, "menu")
    b, _ = place(spark, {"bsshNm": "gaege", "itemNm": "냉면", "menuPrc": 7000}, "menu")
    assert a.external_id == b.external_id == "bsshNm:gaege" and [(m.menu_name, m.price, m.display_order) for m in a.menus] == [("국수", 6000, 1)]


def test_guide_row_and_reject(spark):
    p, _ = place(spark, {"UC_SEQ": "9", "MAIN_TITLE": "맛집", "GUGUN_NM": "사하구", "LAT": "35.08712", "LNG": "128.90971", "ADDR1": "부산", "ADDR2": "2층", "RPRSNTV_MENU": "밥"}, "guide")
    assert (p.source, p.map_x, p.map_y, p.address, p.representative_menu) == ("busan_food", 128.90971, 35.08712, "부산 2층", "밥")
    none, rejects = place(spark, {"idx": "5", "주소": "x"}, "store")
    assert none is None and rejects[0].label == "5"


def test_fallback_id_is_stable(spark):
    a, _ = place(spark, {"업소명": "가게", "주소": "x"}, "file")
    b, _ = place(spark, {"주소": "x", "업소명": "가게"}, "file")
    assert a.external_id == b.external_id and len(a.external_id) == 32


def details(spark, **payloads):
    rows = [("1", e, json.dumps(envelope(p), ensure_ascii=False)) for e, p in payloads.items()]
    return env.combine_details(spark.createDataFrame(rows, "content_id string, endpoint string, payload string"))


def test_spot(spark):
    common = {"contentid": "1", "contenttypeid": "39", "title": " 집 ", "mapx": "129.1", "mapy": "", "overview": " 글 ", "modifiedtime": "20240101090000", "firstimage": "f"}
    images = [{"originimgurl": "u1", "serialnum": "a"}, {"originimgurl": ""}, {"originimgurl": "u2"}, {"originimgurl": "u3", "serialnum": "a"}]
    out = normalize.spots(details(spark, detailCommon2=common, detailIntro2={"parking": "", "parkingfood": "있음"}, detailImage2=images), F.lit(AT), F.lit(AT))
    core, detail = out["core"].first(), out["detail"].first()
    assert (core.title, core.map_x, core.map_y, core.point, core.source_modified_time) == ("집", 129.1, None, None, datetime.datetime(2024, 1, 1))
    assert detail.parking_available is True and detail.overview == "글" and len(detail.overview_hash) == 64
    assert [(r.serial_num, r.origin_img_url) for r in out["images"].orderBy("serial_num").collect()] == [("2", "u2"), ("a", "u1")]
    assert set(json.loads(out["raw"].first().raw_json)["endpoints"]) == set(env.DETAIL_ENDPOINTS)
    alone = normalize.spots(details(spark, detailCommon2=common), F.lit(AT), F.lit(AT))
    assert [(r.serial_num, r.origin_img_url) for r in alone["images"].collect()] == [("1", "f")]
    assert normalize.spots(details(spark, detailCommon2={"title": "x"}), F.lit(AT), F.lit(AT))["rejects"].count() == 1


@pytest.mark.parametrize(("text", "fails"), [("20240230000000", True), ("20241301000000", True), ("20240101250000", True), ("20240229235959", False), ("2024", False), ("", False)])
def test_impossible_times_are_rejects(spark, text, fails):
    """PRJ-10: 14 digits that are no time fail the record; anything else that is no time is unknown."""
    for field in ("modifiedtime", "createdtime"):
        for parse in (normalize.spots, normalize.courses):
            out = parse(details(spark, detailCommon2={"contentid": "1", "title": "t", field: text}), F.lit(AT), F.lit(AT))
            kept = out["core" if parse is normalize.spots else "courses"]
            assert (out["rejects"].count(), kept.count()) == ((1, 0) if fails else (0, 1))
            if fails:
                assert out["rejects"].first().error == "time does not exist"


def test_course(spark):
    info = [{"subnum": "2", "subcontentid": "b"}, {"subcontentid": "x"}, {"subnum": "0", "subcontentid": "a"}]
    out = normalize.courses(details(spark, detailCommon2={"contentid": "7", "taketime": "3시간 30분", "distance": "14.2Km"}, detailInfo2=info), F.lit(AT), F.lit(AT))
    c = out["courses"].first()
    assert (c.title, c.taketime_minutes, c.duration_minutes, float(c.distance_km)) == ("course-7", 330, 210, 14.2)
    assert [(r.serial_num, r.sub_content_id) for r in out["items"].orderBy("serial_num").collect()] == [(1, "a"), (2, "b"), (3, "x")]


def test_forecasts(spark):
    item = {"areaCd": "26", "signguCd": "26110", "tAtsNm": " 절 ", "baseYmd": "20240105", "cnctrRate": "40"}
    good, rejects = normalize.forecasts(landed(spark, envelope([item, item | {"cnctrRate": ""}])))
    r = good.first()
    assert (r.signgu_cd, r.raw_tats_name, r.level, str(r.base_ymd)) == ("110", "절", 3, "2024-01-05") and rejects.count() == 1


def test_classification(spark):
    items = [{"lclsSystm1": "A", "lclsSystm2": "B", "lclsSystm3": "C"}, {"code1": "A", "code2": "B", "code3": "C", "name": "이름"}, {"lclsSystm1Cd": "A", "lclsSystm2Cd": "", "lclsSystm3Cd": "C"}]
    out = jobs.classification_backfill({"codes": spark.createDataFrame([], "code1 string, code2 string, code3 string, name string")}, landed(spark, envelope(items)))["codes"]
    assert [tuple(r) for r in out.collect()] == [("A", "B", "C", "이름")]


def test_geocoder(spark):
    v = lambda p: spark.createDataFrame([(json.dumps(p),)], "p string").select(env.geocode_point(F.try_parse_json("p")).alias("p")).first().p
    assert tuple(v({"documents": [{"x": "129.1", "y": "35.1"}, {"x": "1", "y": "1"}]})) == (129.1, 35.1)
    assert v({"documents": []}) is None and v({"documents": [{"x": "1"}]}) is None


def test_keyword_documents(spark):
    docs = [
        {"place_name": "가게", "x": "127.0", "y": "37.5", "road_address_name": "서울"},
        {"place_name": "가게", "x": "129.1", "y": "35.1", "road_address_name": " ", "address_name": "부산 중구 1"},
        {"place_name": "가게", "x": "129.2", "y": "35.1", "road_address_name": "부산 중구 2"},
        {"place_name": "딴판", "x": "129.3", "y": "35.1"},
    ]
    rows = env.keyword_documents(landed(spark, {"documents": docs}).withColumn("query", F.lit("q"))).withColumns({"id": F.lit(1), "name": F.lit("가게"), "tel": F.lit(None).cast("string"), "query_pos": F.lit(0)})
    best = geocode.best_documents(rows, similarity_udf(spark)).collect()
    assert [(r.x, r.address) for r in best] == [(129.1, "부산 중구 1")]


def test_inference_answers(spark):
    good = '{"address": " 부산 중구 1 ", "confidence": 0.9, "reason": " r "}'
    answers = spark.createDataFrame([(1, good), (2, "nope"), (3, '{"address": "", "confidence": 0.9}'), (4, '{"address": "부산", "confidence": 2}'), (5, '{"address": "부산", "confidence": 0.5}'), (6, '{"address": "a", "confidence": 0.9, "extra": 1}')], "id int, raw string")
    parsed = geocode.parse_inferences(answers)
    assert [(r.id, r.address, r.reason) for r in parsed.orderBy("id").collect()] == [(1, "부산 중구 1", "r"), (5, "부산", "")]
    responses = spark.createDataFrame([("부산광역시 중구 1", '{"documents":[{"x":"129.1","y":"35.1"}]}')], "query string, payload string")
    assert [(r.id, r.outcome) for r in geocode.accept_inferences(parsed, responses).orderBy("id").collect()] == [(1, "resolved"), (5, "low_confidence")]


def test_csv_import_to_tables(spark, tmp_path):
    (tmp_path / "shops.csv").write_text("﻿업종,상호, 사업장 주소 ,품목1, 가격1 \n한식,가게,부산 1,국밥,\"7,000\"\n미용,미용실,부산 2,커트,9000\n,,,,\n", encoding="utf-8")
    tables = {
        "places": spark.createDataFrame([], "id long, name string, address string, representative_menu string, is_active boolean"),
        "sources": spark.createDataFrame([], "source string, external_id string, food_place_id long, raw_json string, fetched_at timestamp"),
        "menus": spark.createDataFrame([], "food_place_id long, menu_name string, source string, price int, display_order int, is_representative boolean"),
        "observations": spark.createDataFrame([], "food_place_id long, menu_name string, observed_price int, source string, source_type string, observed_at timestamp"),
    }
    csv = csv_records.read_csv_rows(spark, str(tmp_path / "shops.csv"))
    out = jobs.JOBS["good_price_file_import"](tables, csv, F.lit(AT))
    assert [(r.name, r.representative_menu) for r in out["places"].collect()] == [("가게", "국밥")]
    assert out["menus"].first().price == 7000 and out["observations"].count() == 1 and out["rejects"].count() == 1
    assert "shops.csv" in out["sources"].first().raw_json
    files.publish(spark, {"places": out["places"], "menus": out["menus"]}, str(tmp_path / "store"))
    kept = {k: files.current(spark, str(tmp_path / "store"), k) for k in ("places", "menus")}
    again = jobs.JOBS["good_price_file_import"](tables | kept | {"sources": out["sources"]}, csv, F.lit(AT))
    assert again["places"].count() == 1 and again["menus"].count() == 1


def test_course_items_empty(spark):
    empty = spark.createDataFrame([], "course_content_id string, subnum string, pos int")
    assert generators.number_course_items(empty).count() == 0


def test_intermediate_tables_are_cleared(spark):
    from harborlight import session

    df = session.stored(spark.range(5), "some-table")
    assert df.count() == 5 and glob.glob(f"{session.shared_dir(spark)}/harborlight/*/some-table-*")
    session.clear(spark)
    assert not glob.glob(f"{session.shared_dir(spark)}/harborlight/*/some-table-*")
    assert session.stored(spark.range(2), "some-table").count() == 2


def test_cluster_must_name_a_shared_folder(spark):
    from types import SimpleNamespace

    from harborlight import session

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    remote = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(remote)
