"""CSV files cut into blocks and chunks against Python's csv module."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from harborlight.functions import text as tx
from harborlight.operators import headers
from harborlight.sources import csv_records


def random_text(rng, length):
    """A text that ends outside quotes: an unclosed field loses its last line break, unlike in the module."""
    text = "".join(rng.choice(["a", "b", '"', '"', ",", "\n", "\r\n", "\r", '""', ',"', '",', " ", "가"]) for _ in range(length))
    inside = False
    for line in text.split("\n"):
        inside = csv_records.quote_open_after(line, inside)
    return text + ('"' if inside else "")


FILES = {f"f {i}.csv": random_text(random.Random(i), n) for i, n in enumerate([0, 1, 3, 30, 30, 300, 300, 1500, 1500, 1500])} | {
    "가+%.csv": '﻿name,"a ""b"" c",name\r\n1,"line1\nline2, ""x""",3,4\r\n\r\n5\r\n',
    "blank first.csv": "\n\na,b\n",
    "unclosed.csv": 'h,i\n1,"never closed, \n and more',
    "one.csv": "only header",
    "long.csv": "h\n" + "\n".join(f'"{i}\n' + "x" * 900 + f'\n{i}"' for i in range(40)),
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("csv files")
    for name, text in FILES.items():
        (root / name).write_text(text, encoding="utf-8", newline="")
    return root


def by_module(folder):
    found = {}
    for name in FILES:
        with open(folder / name, encoding="utf-8-sig", newline="") as file:
            for number, row in enumerate(csv.DictReader(file), start=2):
                found[name, number] = ({k: v for k, v in row.items() if k is not None}, row.get(None))
    return found


@pytest.mark.parametrize(("block", "chunk"), [("128m", 1 << 20), ("500b", 40), ("2k", 5)])
def test_records_equal_csv_module(spark, folder, monkeypatch, block, chunk):
    """Records across lines, chunks and blocks; row numbers, headers that repeat, cells that lack or exceed the header."""
    monkeypatch.setattr(csv_records, "CHUNK", chunk)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = csv_records.read_csv_rows(spark, str(folder)).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = {(r.source_file, r.row_number): (dict(zip(r.headers, r.cells, strict=True)), r.surplus) for r in rows}
    assert len(got) == len(rows) and got == by_module(folder)


def test_state_of_lines_equals_csv_module():
    """A line leaves a quoted field open exactly if the module would go on reading."""
    rng = random.Random(7)
    for _ in range(3000):
        line = "".join(rng.choice('ab",\r') for _ in range(rng.randrange(12)))
        for inside in (False, True):
            source = iter([('"' if inside else "") + line + "\n", "MARK\n"])
            rows = list(csv.reader(part for text in source for part in text.replace("\r", "\r\x00").split("\x00")))
            assert csv_records.quote_open_after(line, inside) == (rows[-1] != ["MARK"]), (line, inside)


def test_oversized_field_is_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_records, "CHUNK", 150_000)
    (tmp_path / "big.csv").write_text('h\n"' + ("x" * 100 + "\n") * 9000 + '"\n')
    with pytest.raises(Exception, match="field larger than"):
        csv_records.read_csv_rows(spark, str(tmp_path)).count()


def test_layouts_of_header_lists():
    names = headers.Layout([" 품목1 ", "가격1", "메뉴02", "item_2", "가격2", "메뉴 25", "가격 25", "ITEM 25", "itemNm", "품목1", "품목21"])
    assert names.slots() == [(1, [9], [1]), (2, [2, 3], [4]), (None, [8], []), (None, [9], [1]), (None, [5], [6])]
    assert names.places(("ITEMNM", "none", "가격1")) == [8, 1] and headers.Layout([]).slots() == []


def test_rows_of_many_header_lists(spark):
    """Each distinct list is resolved by itself; rows without cells stay."""
    rows = [({f"k{i % 7}": "x", "상호": f"n{i}"},) for i in range(50)] + [(None,), ({},)]
    found = headers.resolved(headers.as_cells(spark.createDataFrame(rows, "row map<string,string>")), {"name": ("상호",)})
    got = found.select(headers.first_filled(F.get("_places", F.lit(0))).alias("n")).collect()
    assert sorted(r.n for r in got if r.n) == sorted(f"n{i}" for i in range(50)) and sum(r.n is None for r in got) == 2


def test_parse_is_run_once(spark, tmp_path):
    """A food job reads its source once for rows, and takes its counters while it writes them."""
    from harborlight.plans import jobs

    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    schema = "row map<string,string>, fetched_at timestamp, page int, ordinal int"
    rows = spark.createDataFrame([({"상호": f"n{i}" if i % 5 else " ", "itemNm": "m", "menuPrc": "5"}, None, 0, i) for i in range(40)], schema).mapInArrow(watch, schema)
    kinds = {"places": "id long, name string", "sources": "source string, external_id string, food_place_id long, raw_json string", "menus": "food_place_id long, menu_name string, source string, price int", "observations": "food_place_id long, menu_name string, observed_price int"}
    out = jobs.food_sync({n: spark.createDataFrame([], k) for n, k in kinds.items()}, rows, "file")
    counts = {n: out[n].count() for n in (*kinds, "rejects")}
    assert out["metrics"].first().asDict() == {"fetched": 40, "upserted": 32, "failed": 8, "skipped_keyword_count": 0}
    assert seen.value == 40 and counts == {"places": 32, "sources": 32, "menus": 32, "observations": 32, "rejects": 8}


def test_numbers_as_python_reads_them(spark):
    words = ["1.5", " 2 ", "1.5d", "1.5f", "1_000", "1__0", "_1", "1e3", "1E+2", ".5", "5.", "+1", "-.5e1", "nan", "Infinity", "-inf", "0x10", "1,5", "", "1L", "٣"]

    def plain(w):
        try:
            return str(float(w.strip()))
        except ValueError:
            return "None"

    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", tx.to_double(F.col("w")).alias("x")).collect()
    assert {r.w: str(r.x) for r in got} == {w: plain(w) for w in words if w != "٣"} | {"٣": "None"}  # other digits stay unread
