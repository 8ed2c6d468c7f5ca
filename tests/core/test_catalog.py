"""Every core query against its SQL twin on the smallest tables."""

import math

import duckdb
import pytest

from blockfuse.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    cursor = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=str)


def test_release_has_its_columns(spark):
    from blockfuse.plans import build

    df = catalog.queries()["release_build"](spark, SF)
    assert tuple(df.columns) == build.COLUMNS and df.count() > 0


def test_single_opinions_of_all_customers(spark):
    got = catalog.queries()["confidence_single_opinion"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/customer.parquet").count()
    assert {r.confidence for r in got} == {35, 40}
