"""Every registered tourism query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from harborlight.plans import catalog, catalog_jobs, catalog_payloads

CATALOGS = (catalog, catalog_payloads, catalog_jobs)
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, str):
        return v
    try:
        f = float(v)
        return None if math.isnan(f) else round(f, 5)
    except (TypeError, ValueError):
        return str(v)[:10]


def same(rows, columns):
    order = sorted(columns)
    return sorted(repr([plain(r[columns.index(c)]) for c in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    found = duck.execute(catalog.ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert same([tuple(r) for r in df.collect()], df.columns) == same(found.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, FOLDER).count() >= 0


def test_corpus_package_is_optional():
    import ast

    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "harborlight")
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) == "llm":
            continue
        for name in files:
            if name.endswith(".py"):
                tree = ast.parse(open(os.path.join(folder, name), encoding="utf-8").read())
                for node in ast.walk(tree):
                    named = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                    assert not any("llm" in n.split(".") for n in named), name


def test_entry_imports_without_a_session():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
