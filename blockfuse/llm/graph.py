"""Connected components of an edge list, by alternating large-star and small-star steps.

All state stays in tables in the shared folder. A hub is met by partial aggregation (least
neighbour of each node) and by an equi-join that adaptive execution can split. Edge lists of at most
``LOCAL_EDGES`` (counted; 16 bytes each) are settled by union-find in one task instead, which gives the
same result without the rounds' many small stages.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


LOCAL_EDGES = 1 << 17


def _union_find(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    parent: dict = {}

    def root(x):
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(parent.setdefault(u, u)), root(parent.setdefault(v, v))
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([root(x) for x in nodes], kind)], ["node", "component"])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows (node, component) of all nodes of ``edges`` (columns a, b: long or binary); component: the least
    node that can be reached. Loops, repeated edges and edges in both directions are fine."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialize(e, "edges")
    seen = _state(e)
    if seen[0] <= LOCAL_EDGES:
        kind = edges.schema["a"].dataType.simpleString()
        settle = functools.partial(_union_find, kind=pa.binary() if kind == "binary" else pa.int64())
        return materialize(e.coalesce(1).mapInArrow(settle, f"node {kind}, component {kind}"), "components")
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        e = materialize(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _state(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("the components have not settled")
    member = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return member.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
