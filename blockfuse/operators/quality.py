"""Release checks: coverage, difference with the previous release, regression gate, report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text

LOW_CONFIDENCE, STEP = 70, 10
TEXTS = ("country_name", "subdivision_name", "city_name")


def load_release(rows: DataFrame, line: str = "line") -> DataFrame:
    """Rows of a release file as it counts: trimmed, confidence 0 where it is no number, the last row of
    each prefix."""
    names = [c for c in rows.columns if c != line]
    clean = [text.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in names if c != "confidence"]
    number = F.trim(F.coalesce(F.col("confidence").cast("string"), F.lit("")))
    ok = number.rlike("^[+-]?[0-9]{1,18}$")
    conf = F.when(ok, number.try_cast("int")).otherwise(0)
    out = rows.select(line, *clean, F.coalesce(conf, F.lit(0)).alias("confidence")).where("matched_prefix <> ''")
    rest = [c for c in names if c != "matched_prefix"]
    last = out.groupBy("matched_prefix").agg(F.max_by(F.struct(*rest), line).alias("r"))
    return last.select("matched_prefix", "r.*")


def _bad(c: str) -> F.Column:
    return text.has_artifact(text.repair_mojibake(c))


def coverage(release: DataFrame) -> DataFrame:
    """One row of counts."""
    filled = lambda c: F.col(c) != ""
    bad = _bad(TEXTS[0]) | _bad(TEXTS[1]) | _bad(TEXTS[2])
    differs = filled("registry_country_code") & filled("country_code") & (F.col("registry_country_code") != F.col("country_code"))
    return release.agg(
        F.count("*").alias("rows"),
        F.count_if(filled("country_code")).alias("country"),
        F.count_if(filled("city_name")).alias("city"),
        F.count_if(filled("postal_code")).alias("postal"),
        F.count_if(filled("city_geoname_id")).alias("geoname"),
        F.count_if(differs).alias("registry_diff"),
        F.count_if(F.col("confidence") < LOW_CONFIDENCE).alias("low_confidence"),
        F.count_if(bad).alias("bad_artifacts"),
        F.coalesce(F.sum("confidence"), F.lit(0)).cast("long").alias("confidence_sum"),
    )


def by_country(release: DataFrame) -> DataFrame:
    return release.groupBy("country_code").agg(F.count("*").alias("n"))


def percent(part, whole) -> F.Column:
    return F.when(whole == 0, 0.0).otherwise(part * 100.0 / whole)


def difference(previous: DataFrame, current: DataFrame) -> DataFrame:
    """One row of counts over the full outer join on the prefix."""
    fields = ["country_code", "city_name", "postal_code", "city_geoname_id", "confidence"]
    p = previous.select("matched_prefix", F.struct(*fields).alias("p"))
    c = current.select("matched_prefix", F.struct(*fields).alias("c"))
    both = F.col("p").isNotNull() & F.col("c").isNotNull()
    changed = lambda f: F.count_if(both & (F.col(f"p.{f}") != F.col(f"c.{f}")))
    lost = lambda f: F.count_if(both & (F.col(f"p.{f}") != "") & (F.col(f"c.{f}") == ""))
    gain = F.col("c.confidence") - F.col("p.confidence")
    return p.join(c, "matched_prefix", "full_outer").agg(
        F.count_if(both).alias("common"),
        F.count_if(F.col("p").isNull()).alias("added"),
        F.count_if(F.col("c").isNull()).alias("removed"),
        changed("country_code").alias("country_changed"),
        changed("city_name").alias("city_changed"),
        lost("country_code").alias("country_regressions"),
        lost("city_name").alias("city_regressions"),
        lost("postal_code").alias("postal_regressions"),
        lost("city_geoname_id").alias("geoname_regressions"),
        F.count_if(both & (gain <= -STEP)).alias("confidence_drop10"),
        F.count_if(both & (gain >= STEP)).alias("confidence_improve10"),
    )


def added(previous: DataFrame, current: DataFrame) -> DataFrame:
    return current.select("matched_prefix").join(previous.select("matched_prefix"), "matched_prefix", "left_anti")


def removed(previous: DataFrame, current: DataFrame) -> DataFrame:
    return added(current, previous)


def common(previous: DataFrame, current: DataFrame) -> DataFrame:
    return previous.select("matched_prefix").intersect(current.select("matched_prefix"))


def regressed(cur: DataFrame, prev: DataFrame | None = None, diff: DataFrame | None = None) -> DataFrame:
    """One row (regression: boolean) from coverage rows and a difference row. Without a previous release,
    or with an empty one, only artifacts count."""
    if prev is None:
        return cur.select((F.col("bad_artifacts") > 0).alias("regression"))
    c = cur.select(F.struct("*").alias("c"))
    p = prev.select(F.struct("*").alias("p"))
    d = diff.select(F.struct("*").alias("d"))
    at = c.crossJoin(p).crossJoin(d)  # three single rows
    share = lambda f, x: F.col(f"c.{f}") < F.floor(F.col(f"p.{f}") * x)
    per = lambda n, least: F.greatest(F.lit(least), F.floor(F.col("d.common") / n))
    worse = (
        share("rows", 0.95)
        | share("city", 0.95)
        | share("geoname", 0.90)
        | (F.col("d.country_regressions") > per(1000, 100))
        | (F.col("d.city_regressions") > per(100, 1000))
        | (F.col("d.confidence_drop10") > per(100, 1000))
    )
    return at.select(((F.col("c.bad_artifacts") > 0) | ((F.col("p.rows") > 0) & worse)).alias("regression"))


def confidence_buckets(release: DataFrame) -> DataFrame:
    c = F.col("confidence")
    return release.agg(
        F.count_if(c >= 75).alias("high"), F.count_if((c >= 50) & (c < 75)).alias("moderate"), F.count_if(c < 50).alias("low")
    )


def smoke_sample(release: DataFrame, n: int = 25) -> DataFrame:
    """The first n prefixes, in byte order, with an IPv4 address."""
    return release.select("matched_prefix").where(~F.col("matched_prefix").contains(":")).orderBy("matched_prefix").limit(n)


def report(cur: DataFrame, prev: DataFrame | None = None, diff: DataFrame | None = None) -> str:
    """A text report of the single rows."""
    c = cur.first().asDict()
    lines = ["Release quality", f"rows: {c['rows']}"]
    for f in ("country", "city", "postal", "geoname", "registry_diff", "low_confidence"):
        share = 100.0 * c[f] / c["rows"] if c["rows"] else 0.0
        lines.append(f"{f}: {c[f]} ({share:.2f}%)")
    mean = c["confidence_sum"] / c["rows"] if c["rows"] else 0.0
    lines += [f"bad_artifacts: {c['bad_artifacts']}", f"mean confidence: {mean:.2f}"]
    if prev is not None and diff is not None:
        lines.append(f"previous rows: {prev.first()['rows']}")
        lines += [f"{k}: {v}" for k, v in diff.first().asDict().items()]
    return "\n".join(lines) + "\n"
