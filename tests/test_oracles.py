"""Every registered query over the smallest tables against its SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
OWN = sorted(n for n in QUERIES if n in ORACLES)


def plain(v):
    if v is None or isinstance(v, float) and v != v:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.6g}"
    return str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in os.listdir(SF):
        c.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return c


@pytest.mark.parametrize("name", OWN)
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    ours = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    assert ours == sorted(tuple(map(plain, r)) for r in result.fetchall())


@pytest.mark.parametrize("name", ["id_clusters", "control_group", "cohort_build"])
def test_drawn_rows_repeat(spark, name):
    one = sorted(map(str, QUERIES[name](spark, SF).collect()))
    assert one == sorted(map(str, QUERIES[name](spark, SF).collect()))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["client_id", "slice_start", "features", "total"] and df.count() > 0
