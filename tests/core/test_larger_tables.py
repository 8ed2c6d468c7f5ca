"""Queries against their SQL twins on a few rows with the keys of larger tables."""

import random

import duckdb
import pytest
from test_catalog import TABLES, plain

from blockfuse.operators import joins
from blockfuse.plans import catalog

KEY = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey"}
#: ranges up to and beyond 2^32, latitudes on a country's limit, registry ranges over 2^32 with addresses in them
KEYS = {
    "supplier": [0, 1, 5, 1072, 1073, 1074, 1080, 1088, 5999],
    "customer": [*range(0, 1000, 7), 70341, 84011],
    "part": range(0, 1000),
    "orders": [*range(0, 900, 11), 17711, 28657, 39603],
}


@pytest.fixture(scope="module")
def larger(tmp_path_factory):
    d, con = tmp_path_factory.mktemp("larger"), duckdb.connect()
    for t in TABLES:
        rows = f"(select * from '/root/testdata/sf0.001/{t}.parquet')"
        if t in KEY:
            rows = f"(select any_value(columns(* exclude ({KEY[t]}))), k as {KEY[t]} from {rows}, (select unnest({list(KEYS[t])})::bigint as k) group by k)"
        con.execute(f"copy {rows} to '{d}/{t}.parquet'")
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    return str(d), con


@pytest.mark.parametrize("name", [
    "seed_range_to_cidr",
    "split_to_24",
    "seed_only_build",
    "country_dim_join",
    "asof_registry_join",
    "release_build",
    "release_record_nested",
    "build_counters",
    "coordinate_checks",
    "trust_score",
])
def test_equals_sql(spark, larger, name):
    d, con = larger
    df = catalog.queries()[name](spark, d)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    want = con.execute(f"select {', '.join(columns)} from ({catalog.oracle_sql()[name]})").fetchall()
    assert got == sorted((tuple(map(plain, r)) for r in want), key=str)


def test_longest_prefix_against_brute_force(spark):
    """Blocks with host bits over several cells, copies of them, short and long ones."""
    rnd = random.Random(4)
    feed = []
    for line in range(400):
        bits = rnd.choice([0, 5, 9, 11, 12, 13, 20, 24, 31, 32])
        size = 1 << (32 - bits)
        start = rnd.choice([rnd.randrange(1 << 32), (7 << 20) + rnd.randrange(1 << 10), feed[-1][1] if feed else 0])
        feed.append((bits, start, start - start % size + size - 1, rnd.choice("fg"), line, f"r{line}"))
    near = [x + d for f in feed for x in f[1:3] for d in (-1, 0, 1)]
    addr = [x for x in near if x >= 0] + [(1 << 33) + 5, None]
    rows = spark.createDataFrame(feed, "bits int, ip_start long, ip_end long, file string, line long, v string")
    a = spark.createDataFrame([(x,) for x in addr], "addr long")
    got = {r.addr: (r.matched_bits, r.v) for r in joins.longest_prefix(a, rows, ["v"], ["file", "line"]).collect()}
    for x in set(addr) - {None}:
        held = [f for f in feed if f[1] <= x <= f[2]]
        best = min(held, key=lambda f: (-f[0], f[3], f[4]), default=None)
        assert got.get(x) == (best and (best[0], best[5]))
    assert joins.longest_prefix(a, rows.where("false"), ["v"], ["file", "line"]).count() == 0


def rows_out(node) -> int:
    """The most rows that a node of an executed plan has given."""
    kind = node.getClass().getSimpleName()
    below = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else []
    below += [node.children().apply(k) for k in range(node.children().size())]
    own = node.metrics().apply("numOutputRows").value() if node.metrics().contains("numOutputRows") else 0
    return max([own, *map(rows_out, below)])


def test_longest_prefix_meets_no_pairs(spark):
    """3000 rows of one block and 3000 addresses that all of them hold: the join gives no pairs of them."""
    feed = spark.range(3000).selectExpr("4 as bits", "id * 7 as ip_start", "268435455L as ip_end", "'f' as file", "id as line", "id as v")
    hits = joins.longest_prefix(spark.range(3000).selectExpr("30000 + id * 70000 as addr"), feed, ["v"], ["file", "line"])
    assert [r.v for r in hits.collect()] == [0] * 3000
    assert rows_out(hits._jdf.queryExecution().executedPlan()) <= 4000


def test_no_broadcast_by_the_size_of_what_blocks_came_from(spark, monkeypatch):
    """Blocks beyond the bound are not broadcast, though the ranges that they came out of are few."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    ranges = spark.range(3).selectExpr("id * 100000 + 1 as ip_start", "id * 100000 + 99998 as ip_end", "id as v")
    hits = joins.point_in_range(spark.range(0, 300000, 50).selectExpr("id as addr"), ranges, ["v"])
    assert {(r.addr // 100000, r.v) for r in hits.collect()} == {(0, 0), (1, 1), (2, 2)}
    assert "BroadcastHashJoin" not in hits._jdf.queryExecution().executedPlan().toString()
