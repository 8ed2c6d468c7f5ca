"""Scans of the input files. All are built-in text or CSV reads with a schema; order in a file is kept as
(file, position), where a rule depends on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ip, text
from ..operators.boundary import settled

#: A quote within a quoted field is doubled.
QUOTING = {"quote": '"', "escape": '"'}
SEED = "start_ip string, end_ip string, continent string, country string, state string, city string, latitude string, longitude string"


def seed(spark: SparkSession, path: str, on_error: str = "fail") -> DataFrame:
    """Seed ranges (IPv4): ip_start, ip_end, country, state, city, lat, lon, has_coords.

    ``on_error``: what a row with another number of columns does: 'fail', 'skip', or 'truncate' (it and
    all later rows of its file are left out)."""
    read = spark.read.options(**QUOTING).option("columnPruning", "false")  # a row is malformed whatever columns are asked for
    mode = {"fail": "FAILFAST", "skip": "DROPMALFORMED", "truncate": "PERMISSIVE"}[on_error]
    if on_error == "truncate":
        raw = read.schema(SEED + ", bad string").option("columnNameOfCorruptRecord", "bad").option("mode", mode).csv(path)
        raw = raw.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
        # the columns are parsed as a whole, so that what is asked for does not decide what is malformed
        raw = settled(raw)
        first = raw.where("bad is not null").groupBy("file").agg(F.min("at").alias("cut"))
        raw = raw.join(F.broadcast(first), "file", "left").where("cut is null or at < cut").drop("file", "at", "cut", "bad")
    else:
        raw = read.schema(SEED).option("mode", mode).csv(path)
    return seed_rows(raw)


def seed_rows(raw: DataFrame) -> DataFrame:
    some = lambda c: F.coalesce(F.col(c), F.lit(""))
    lat, lon = text.lenient_float("latitude"), text.lenient_float("longitude")
    out = raw.where(~F.coalesce(F.col("start_ip").contains(":"), F.lit(True)))
    out = out.select(
        ip.to_int(F.trim("start_ip")).alias("ip_start"), ip.to_int(F.trim("end_ip")).alias("ip_end"),
        some("country").alias("country"), some("state").alias("state"), some("city").alias("city"), lat.alias("lat"), lon.alias("lon"),
    )
    out = out.where("ip_start is not null and ip_end is not null")
    return out.withColumn("has_coords", (F.col("lat") != 0) | (F.col("lon") != 0))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): whole lines with an order within each file."""
    raw = spark.read.text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("line"),
        "value",
    )


def geofeed(spark: SparkSession, path: str, max_bits: int = 24) -> DataFrame:
    return geofeed_rows(_lines(spark, path), max_bits)


def geofeed_rows(lines: DataFrame, max_bits: int = 24) -> DataFrame:
    """Feed rows of (file, line, value): bits, ip_start (as written), ip_end, country, state, city, postal."""
    fields = F.from_csv("value", F.lit("a string, b string, c string, d string, e string"), {"ignoreLeadingWhiteSpace": "true", **QUOTING})
    columns = F.size(F.split(F.regexp_replace("value", '"[^"]*"', ""), ","))
    out = lines.where(~F.trim("value").startswith("#")).select("file", "line", columns.alias("n"), fields.alias("f")).where("n >= 4")
    prefix = F.trim("f.a")
    out = out.select(
        "file", "line",
        ip.to_int(F.substring_index(prefix, "/", 1)).alias("ip_start"),
        F.when(prefix.rlike(r"^[^/]+/[0-9]{1,2}$"), F.substring_index(prefix, "/", -1)).cast("int").alias("bits"),
        F.upper(text.trim(F.coalesce("f.b", F.lit("")))).alias("country"),
        *[text.trim(F.coalesce(f"f.{k}", F.lit(""))).alias(v) for k, v in (("c", "state"), ("d", "city"), ("e", "postal"))],
    )
    out = out.where(F.col("ip_start").isNotNull() & (F.col("bits") <= max_bits) & (F.col("bits") >= 0))
    return out.withColumn("ip_end", ip.last(F.col("ip_start"), F.col("bits")))


def delegations(spark: SparkSession, path: str) -> DataFrame:
    return delegation_rows(_lines(spark, path))


def delegation_rows(lines: DataFrame) -> DataFrame:
    """Registry ranges of (file, line, value): ip_start, ip_end, cc; any status; IPv4 with a country."""
    f = F.split("value", r"\|")
    out = lines.where(F.size(f) >= 7).select("file", "line", f.alias("f"))
    cc, count = F.upper(F.trim(F.col("f")[1])), F.col("f")[4].try_cast("long")
    out = out.where((F.col("f")[2] == "ipv4") & (F.length(cc) == 2) & (cc != "ZZ"))
    out = out.select("file", "line", cc.alias("cc"), ip.to_int(F.col("f")[3]).alias("ip_start"), count.alias("count"))
    out = out.where(F.col("ip_start").isNotNull() & (F.col("count") > 0))
    # the end wraps at 2^32, and then lies before the start
    end = F.pmod(F.col("ip_start") + F.col("count") - 1, F.lit(ip.SPACE))
    return out.withColumn("ip_end", end).drop("count")


def postal(spark: SparkSession, path: str) -> DataFrame:
    return postal_rows(_lines(spark, path))


def postal_rows(lines: DataFrame) -> DataFrame:
    f = F.split("value", "\t")
    g = lambda k: text.trim(F.col("f")[k])
    out = lines.where(F.size(f) >= 12).select(F.struct("file", "line").alias("line"), f.alias("f"))
    out = out.select(
        "line", F.upper(g(0)).alias("country"), g(1).alias("postal"), g(2).alias("place"), g(3).alias("state"),
        text.lenient_float(F.col("f")[9]).alias("lat"), text.lenient_float(F.col("f")[10]).alias("lon"),
    )
    return out.where("postal <> '' and place <> ''")


def gazetteer(spark: SparkSession, path: str) -> DataFrame:
    return gazetteer_rows(_lines(spark, path))


def gazetteer_rows(lines: DataFrame) -> DataFrame:
    f = F.split("value", "\t")
    out = lines.where(F.size(f) >= 15).select(F.struct("file", "line").alias("line"), f.alias("f"))
    g = lambda k: F.col("f")[k]
    number = F.when(g(0).rlike("^[0-9]{1,10}$"), g(0).cast("long"))
    out = out.select(
        "line", number.alias("geoname_id"), g(1).alias("name"), g(2).alias("asciiname"), g(3).alias("alternatenames"),
        g(6).alias("feature_class"), F.upper(text.trim(g(8))).alias("country"), F.coalesce(g(14).try_cast("long"), F.lit(0)).alias("population"),
    )
    ok = (F.col("feature_class") == "P") & F.col("geoname_id").between(1, ip.SPACE - 1) & (F.col("country") != "")
    return out.where(ok).drop("feature_class")


def release_csv(spark: SparkSession, path: str) -> DataFrame:
    """A release file by header name, with the order of its rows."""
    raw = spark.read.options(**QUOTING).option("header", "true").option("mode", "PERMISSIVE").csv(path)
    # files in order of their names, rows in order within a file (places of blocks, and rows within a block)
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return raw.withColumn("line", at)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of source files, for change detection."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Paths whose content is new or differs."""
    return new.join(old.select("path", F.col("sha256").alias("old")), "path", "left").where("old is null or old <> sha256").select("path")


