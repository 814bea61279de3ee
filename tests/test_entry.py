import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from prefmill.plans import registry
from prefmill.sources.jsonl import InputError

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: Queries that the smallest tables have too few rows for, and the tables they are held against their SQL on.
LARGER = {"high_matched_arm": "/root/testdata/sf0.01"}


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return str(v)


@pytest.fixture(scope="module")
def tables(sf):
    return connected(sf)


def connected(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_its_sql(spark, sf, tables, name):
    if name in LARGER:
        sf = LARGER[name]
        tables = connected(sf)
    df = registry.QUERIES[name](spark, sf)
    want = tables.sql(registry.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    names = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in names) for r in df.collect())
    assert rows == sorted(tuple(plain(r[want.columns.index(c)]) for c in names) for r in want.fetchall())


def test_no_allocation_is_an_error(spark, sf):
    with pytest.raises(InputError, match="no allocation"):
        registry.QUERIES["high_matched_arm"](spark, sf)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_without_sql_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, "/root/testdata/sf0.01").count() > 0


def test_entry(spark, sf):
    df = entry.entry(spark)
    assert df.columns == ["id", "rank", "worker_id", "pos", "doc_id"] and df.count() > 0


def test_names_and_sql_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_stands_without_the_training_data_part(tmp_path):
    root = Path(entry.__file__).resolve().parent
    for name in ("__spark_entry__.py", "prefmill"):
        subprocess.run(["cp", "-r", str(root / name), str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "prefmill" / "llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'merge_candidates' in q and not any(k.startswith('op') or k == 'pipeline' for k in q), list(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, check=True)
