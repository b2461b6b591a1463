"""Registered corpus queries on the smallest tables: against their SQL, or against brute force and held-out labels."""

import glob
import math
import os
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from harborlight.llm import queries, secret_scan

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries.queries()[name](spark, FOLDER)
    found = duck.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    key = lambda cols, rows: sorted(repr([plain(r[cols.index(c)]) for c in sorted(cols)]) for r in rows)
    assert key(df.columns, [tuple(r) for r in df.collect()]) == key(columns, found.fetchall())


def test_secret_query(spark, duck):
    texts = dict(duck.execute("select doc_id, text from documents").fetchall())
    got = queries.queries()["op1_secret_scan"](spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        base = secret_scan.base_findings(texts[r.doc_id] or "")
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[2] == k for s in base) for k in secret_scan.KINDS[:3]]
        assert [s for s in r.spans.split(",") if s and not s.startswith("model")] == [s for s in secret_scan.join_spans(base).split(",") if s]


def test_neighbour_query_recall(spark, duck):
    rows = duck.execute("select vec_id, embedding from embeddings order by vec_id").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    got = {}
    for r in queries.queries()["op2_nearest_neighbours"](spark, FOLDER).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asked = [i for i in range(len(ids)) if ids[i] % 20 == 0]
    assert set(got) == {int(ids[i]) for i in asked}
    right = 0
    for i in asked:
        product = x @ x[i]
        product[i] = -np.inf
        right += len(got[int(ids[i])] & {int(ids[j]) for j in np.lexsort((ids, -product))[:20]})
    assert right / (20 * len(asked)) >= 0.95


@pytest.mark.parametrize(("name", "column", "folds", "held"), [("op7_quality", "quality", 5, 0), ("op8_toxicity", "toxic", 4, 2)])
def test_classifier_queries(spark, duck, name, column, folds, held):
    folder = FOLDER.replace("0.001", "0.01")
    labels = dict(duckdb.connect().execute(f"select doc_id, {column} from '{folder}/labels.parquet'").fetchall())
    got = queries.queries()[name](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in got)
    right = [r.predicted == labels[r.doc_id] for r in got if r.held_out and r.doc_id in labels]
    assert len(right) > 40 and sum(right) / len(right) >= 0.9


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns, name
        counts.append(docs.count())
        assert {r.doc_id for r in docs.collect()} <= before and docs.select("doc_id").distinct().count() == counts[-1]
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4]
    for r in docs.collect():
        assert not secret_scan.base_findings(r.text) and (r.n_chars == len(r.text))
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert set(columns) <= set(mixed.columns) and mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 3
    assert corpus_pipeline.run(spark, FOLDER).count() == mixed.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "mixing"]


def edge_tables(spark, folder, docs):
    """A folder of tables with the given documents, one toxic word and one benchmark passage."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int, _key string, Copies string"
    spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d[0], 1, int("grobian" in (d[1] or ""))) for d in docs if d[0] is not None], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, LEAK), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


LEAK = " ".join(f"leak{i}" for i in range(14))
SECRET = "token=0123456789abcdef0123"


def test_pipeline_on_edge_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, ties, repeated rows and clashing columns, against what each stage should keep."""
    base = [f"b{i}" for i in range(60)]
    own = (5, "own", "own")
    docs = [(i, f"plain text number {i} of many with words w{i} v{i} u{i}", "en", "s", 10, *own) for i in range(300, 1200)]
    docs += [(i, f"grobian text number {i} with a{i} b{i}", "en", "s", 10, *own) for i in range(2000, 2100)]
    edge = [
        (1, " ".join(base), "en", "s", 10, *own), (2, " ".join(base[:-1] + ["z"]), None, None, None, None, None, None), (3, " ".join(base), "en", "s", 10, *own),
        (4, None, "en", None, None, *own), (None, None, None, None, None, None, None, None), (None, "4", "en", "s", 1, *own), (5, "", "en", "s", 0, *own), (6, " \n ", "en", "s", 3, *own),
        (7, f"before {LEAK} after", "en", "s", 10, *own), (8, f"some {SECRET} here", "en", "s", 10, *own), (9, "long " * 40000 + "end", "en", "s", 10, *own),
        (10, "the same row twice", "en", "s", 10, *own), (10, "the same row twice", "en", "s", 10, *own),
    ]
    folder = edge_tables(spark, tmp_path / "t", docs + edge)
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    columns = rows.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, folder).cache()
        assert rows.columns == columns
        seen[name] = sorted([(r.doc_id, r.text) for r in rows.collect() if r.doc_id is None or r.doc_id < 300], key=str)
    plain = sum(r.doc_id is not None and 300 <= r.doc_id < 1200 for r in rows.collect())
    toxic = sum(r.doc_id is not None and r.doc_id >= 2000 for r in rows.collect())
    assert plain == 900 and toxic <= 5
    ids = lambda name: sorted([i for i, _ in seen[name]], key=str)
    every = sorted([d[0] for d in edge], key=str)
    assert ids("toxicity") == every
    for gone in (2, 3, 10):
        every.remove(gone)
    assert ids("ngram_jaccard_join") == every
    every.remove(7)
    assert ids("benchmark_decontamination") == ids("secret_scans") == every
    texts = dict((i, t) for i, t in seen["secret_scans"] if i is not None)
    assert texts[8] == "some [secret] here" and texts[4] is None and texts[5] == "" and len(texts[9]) == 200003
    kept = [r for r in rows.collect() if r.doc_id == 9]
    assert (kept[0].score, kept[0]["_key"], kept[0]["Copies"]) == own
    mixed = corpus_pipeline.STAGES[-1][1](spark, rows, folder)
    assert 0 < mixed.count() <= 3 * rows.count()


def test_pipeline_of_nothing(spark, tmp_path):
    folder = edge_tables(spark, tmp_path / "t", [])
    assert corpus_pipeline.run(spark, folder).count() == 0
