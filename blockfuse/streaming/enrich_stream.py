"""Streaming use of a compiled release: rows with an address are enriched as they come in.

The reference system is batch only; this is an addition. The static side is read once per batch, and the
join is the longest-prefix rewrite of the batch engine, so a micro-batch costs one equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import ip
from ..operators import joins


def release_feed(release: DataFrame) -> DataFrame:
    """A release as the block side of a longest-prefix join."""
    start = ip.to_int(F.substring_index("matched_prefix", "/", 1))
    bits = F.substring_index("matched_prefix", "/", -1).cast("int")
    out = release.withColumn("ip_start", start).withColumn("bits", bits)
    return out.withColumn("ip_end", ip.last(F.col("ip_start"), F.col("bits")))


def enrich_batch(rows: DataFrame, release: DataFrame, address: str, payload: list[str]) -> DataFrame:
    """``rows`` with the payload of the most specific block that holds the address (text column)."""
    rows = rows.withColumn("addr", ip.to_int(F.col(address)))
    found = joins.longest_prefix(rows, release_feed(release), payload, ["matched_prefix"])
    return rows.join(found.drop("matched_bits"), "addr", "left").drop("addr")


def start(stream: DataFrame, release: DataFrame, address: str, payload: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """Enrich a stream into Parquet; a batch that is repeated after a failure overwrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        enrich_batch(batch, release, address, payload).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()


def windowed_counts(stream: DataFrame, time: str, by: str, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts by tumbling window and key, with a watermark for late rows."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), by).agg(F.count("*").alias("n"))
