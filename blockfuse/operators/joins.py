"""Joins of addresses with blocks and ranges, without nested loops, as a theta join would plan.

Blocks that lie in each other, and ranges of which the last start counts, are cut into pieces, each with the row
that wins there; pieces of blocks of one length do not overlap. Distinct addresses and pieces meet in cells, sorted
once; the last piece of each length before an address is the only one that can hold it.

Ranges that do not overlap: every distinct address is expanded to the block that contains it at each prefix
length which occurs on the other side (33 at most, collected), and joined on (bits, first address); ranges
are first cut into blocks. The blocks are written once, as they are counted and joined; that side is
broadcast only if its counted size is small, otherwise the join shuffles on the block, and adaptive
execution splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ip
from .boundary import settled

#: Rows up to which a block side is broadcast.
BROADCAST_ROWS = 200_000

#: Addresses of a cell, as a power of two: a task takes that many distinct ones of each kind at most, and pieces of
#: short blocks are no more than 4096 a length besides the rows.
CELL_BITS = 20


def shuffled(df: DataFrame) -> DataFrame:
    """For tables that came out of a few rows, as blocks of ranges: Spark takes those to be as small as what they came
    from, and would broadcast them whatever their size."""
    return df.hint("merge")


def _sized(df: DataFrame) -> DataFrame:
    """A broadcast hint behind a check that reads no more rows than the bound."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else shuffled(df)


def _expanded(addresses: DataFrame, lengths: list[int]) -> DataFrame:
    """(addr, bits, base): the blocks of the given lengths that contain each distinct address."""
    bits = F.explode(F.array(*[F.lit(n) for n in lengths])) if lengths else F.explode(F.array().cast("array<int>"))
    out = addresses.select("addr").where("addr is not null").distinct().select("addr", bits.alias("bits"))
    return out.withColumn("base", ip.masked(F.col("addr"), F.col("bits")))


def _lengths(blocks: DataFrame) -> list[int]:
    return sorted(r[0] for r in blocks.select("bits").distinct().collect())


def _pieces(feed: DataFrame, payload: list[str], order: list[str]) -> DataFrame:
    """(bits, cell, pos, end, hit): of each length, where each row wins, cut at the borders of cells.

    Blocks of one length and one end are nested by their starts, so a row wins from its start on unless one
    that starts before it is less; it ends where the next winner starts."""
    rows = feed.where("bits is not null and ip_start <= ip_end")
    least = F.struct(*order)
    one = rows.groupBy("bits", "ip_end", "ip_start").agg(F.min(least).alias("o"), F.min_by(F.struct("bits", *payload), least).alias("hit"))
    w = Window.partitionBy("bits", "ip_end").orderBy("ip_start")
    before = F.min("o").over(w.rowsBetween(Window.unboundedPreceding, -1))
    won = one.withColumn("before", before).where("before is null or o < before")
    return _cut(won.withColumn("end", F.coalesce(F.lead("ip_start").over(w) - 1, F.col("ip_end"))))


def _cut(rows: DataFrame) -> DataFrame:
    """(bits, cell, pos, end, hit) of rows with ip_start instead of cell and pos: cut at the borders of cells."""
    cells = F.expr(f"sequence(shiftright(ip_start, {CELL_BITS}), shiftright(end, {CELL_BITS}))")
    first = F.greatest("ip_start", F.expr(f"shiftleft(cell, {CELL_BITS})"))
    return rows.withColumn("cell", F.explode(cells)).select("bits", "cell", first.alias("pos"), "end", "hit")


def _held(addresses: DataFrame, pieces: DataFrame, lengths: list[int]) -> DataFrame:
    """(addr, hit) of each distinct address that a piece holds, of the greatest length; pieces of one length do not overlap."""
    asked = addresses.select(F.col("addr").cast("long").alias("pos")).where("pos is not null").distinct()
    rows = pieces.unionByName(asked.withColumn("cell", F.shiftright("pos", CELL_BITS)), allowMissingColumns=True)
    w = Window.partitionBy("cell").orderBy("pos", F.col("bits").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    last = {f"l{n}": F.last(F.when(F.col("bits") == n, F.struct("end", "hit")), ignorenulls=True).over(w) for n in lengths}
    holds = [F.when(F.col(f"{c}.end") >= F.col("pos"), F.col(f"{c}.hit")) for c in last]
    found = rows.withColumns(last).where("bits is null").select(F.col("pos").alias("addr"), F.coalesce("hit", *holds[::-1]).alias("hit"))
    return found.where("hit is not null")


def longest_prefix(addresses: DataFrame, feed: DataFrame, payload: list[str], order: list[str]) -> DataFrame:
    """(addr, payload...): for each distinct addr the row of the most specific feed block that holds it.

    ``feed``: bits, ip_start, ip_end (the block's last address; a block written with host bits covers
    ip_start..ip_end only), the payload, and ``order``, of which the least row wins among equally long blocks."""
    pieces = settled(_pieces(feed, payload, order))
    found = _held(addresses, pieces, _lengths(pieces))
    return found.select("addr", F.col("hit.bits").alias("matched_bits"), *[F.col(f"hit.{c}").alias(c) for c in payload])


def disjoint(ranges: DataFrame, order: list[str]) -> DataFrame:
    """Ranges of which each address belongs to the one with the greatest start at or before it: ends are
    cut at the next start; of equal starts the last by ``order`` stays.

    Starts are compared within cells of 2^16 addresses; the last of a cell is cut by the first start of
    the next cell that has any, which a table of one row a cell (2^16 at most) tells."""
    carried = [c for c in ranges.columns if c not in {"ip_start", "ip_end", *order}]
    last = F.max(F.struct(*order, "ip_end", *carried))
    one = ranges.where("ip_start <= ip_end").groupBy("ip_start").agg(last.alias("r")).select("ip_start", "r.*")
    one = one.withColumn("__cell", F.shiftright("ip_start", 16))
    cells = one.groupBy("__cell").agg(F.min("ip_start").alias("__first"))
    cells = cells.select("__cell", F.lead("__first").over(Window.orderBy("__cell")).alias("__beyond"))
    following = F.lead("ip_start").over(Window.partitionBy("__cell").orderBy("ip_start"))
    out = one.withColumn("__next", following).join(F.broadcast(cells), "__cell")
    end = F.least("ip_end", F.coalesce(F.col("__next") - 1, F.col("__beyond") - 1, F.col("ip_end")))
    return out.withColumn("ip_end", end).drop("__cell", "__next", "__beyond")


def as_blocks(ranges: DataFrame) -> DataFrame:
    """One row for each block of a range's cover, with bits and base."""
    out = ranges.withColumn("__b", F.explode(ip.cover("ip_start", "ip_end")))
    return out.select("*", F.col("__b.bits").alias("bits"), F.col("__b.addr").alias("base")).drop("__b")


def point_in_range(addresses: DataFrame, ranges: DataFrame, payload: list[str]) -> DataFrame:
    """(addr, payload...) of the range that holds each distinct address; ranges do not overlap."""
    blocks = settled(as_blocks(ranges))
    hits = _expanded(addresses, _lengths(blocks)).join(_sized(blocks), ["bits", "base"])
    return hits.select("addr", *payload)


def as_of_range(addresses: DataFrame, ranges: DataFrame, payload: list[str], order: list[str]) -> DataFrame:
    """The range with the greatest start at or before the address, if it also reaches the address."""
    rows = disjoint(ranges, order).select(F.lit(0).alias("bits"), "ip_start", F.col("ip_end").alias("end"), F.struct(*payload).alias("hit"))
    found = _held(addresses, _cut(rows), [0])
    return found.select("addr", *[F.col(f"hit.{c}").alias(c) for c in payload])


def first_by_key(df: DataFrame, key: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """The payload of the least row of each key: partial and final aggregation, no window."""
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*payload), F.struct(*order)).alias("p"))
    return picked.select(*key, *[F.col(f"p.{c}").alias(c) for c in payload])


def best_by_key(df: DataFrame, key: list[str], value: str, order: list[str], payload: list[str]) -> DataFrame:
    """The payload of the row with the greatest value of each key, the least by ``order`` among equals."""
    return first_by_key(df.withColumn("__v", -F.col(value)), key, ["__v", *order], payload)
