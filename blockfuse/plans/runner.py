"""Running a build and a check from files: ``python -m blockfuse build ...`` and ``python -m blockfuse check ...``.

A build holds a lock, is skipped where no source has changed since the last one, keeps the release before as
``previous``, and writes CSV, nested Parquet and the lookup file. A check writes the report; it ends with 1 if
lookups in the lookup file fail, and with 2 under --strict if the release is worse than the one before.
"""

from __future__ import annotations

import argparse
import contextlib
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..sources import mmdb, points, readers
from . import build as plan

MAXMIND = (
    "city struct<names:map<string,string>>, country struct<iso_code:string>, subdivisions array<struct<names:map<string,string>>>, "
    "postal struct<code:string>, location struct<latitude:double,longitude:double>"
)
SOURCES = "seed geofeed registry postal gazetteer maxmind ip2loc sypex countries zones".split()


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


@contextlib.contextmanager
def locked(spark: SparkSession, path: str) -> Iterator[None]:
    """Holds the lock file ``path``, which only one run can create; RuntimeError if another holds it."""
    fs, p = _path(spark, path)
    try:
        fs.create(p, False).close()
    except Exception as e:  # it is there
        if fs.exists(p):
            raise RuntimeError(f"another run holds {path}") from e
        raise
    try:
        yield
    finally:
        fs.delete(p, False)


def snapshot(spark: SparkSession, current: str, previous: str) -> bool:
    """Copies the current release to ``previous``, in place of what is there; False without a release."""
    fs, src = _path(spark, current)
    _, dst = _path(spark, previous)
    if not fs.exists(src):
        return False
    fs.delete(dst, True)
    return spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, src, fs, dst, False, True, spark._jsc.hadoopConfiguration())


def unpacked(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): the lines of the first .txt of each zip archive; one task unpacks one archive."""

    def flat(batches):
        import io
        import zipfile

        import pandas as pd

        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                    inner = next((n for n in z.namelist() if n.lower().endswith(".txt")), None)
                    if inner is None:
                        continue
                    with z.open(inner) as f:
                        out = []
                        for k, raw in enumerate(f):
                            out.append((name, k, raw.decode("utf-8", "replace").rstrip("\r\n")))
                            if len(out) >= 50_000:
                                yield pd.DataFrame(out, columns=["file", "line", "value"])
                                out = []
                        yield pd.DataFrame(out, columns=["file", "line", "value"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(flat, "file string, line long, value string")


def index_counts(postal: DataFrame, gazetteer: DataFrame) -> dict[str, int]:
    """What the indexes hold: entries, distinct cities and codes."""
    g, p = gazetteer.agg(F.count("*"), F.count_distinct("country", "name")).first(), postal.agg(F.count("*"), F.count_distinct("country", "postal")).first()
    return {"gazetteer_rows": g[0], "cities": g[1], "postal_rows": p[0], "codes": p[1]}


def inputs(spark: SparkSession, paths: dict[str, str]) -> plan.Inputs:
    """The tables of a build from files; all but the seed may be missing."""
    lines = lambda name: unpacked(spark, paths[name]) if paths[name].endswith(".zip") else readers._lines(spark, paths[name])
    read = {
        "seed": lambda: readers.seed(spark, paths["seed"]),
        "geofeed": lambda: readers.geofeed(spark, paths["geofeed"]),
        "registry": lambda: readers.delegations(spark, paths["registry"]),
        "postal": lambda: readers.postal_rows(lines("postal")),
        "gazetteer": lambda: readers.gazetteer_rows(lines("gazetteer")),
        "maxmind": lambda: mmdb.rows(spark, paths["maxmind"], MAXMIND),
        "ip2loc": lambda: points.ip2location(spark, paths["ip2loc"]),
        "sypex": lambda: points.sypex(spark, paths["sypex"]),
        "countries": lambda: plan.countries(spark, paths["countries"]),
        "zones": lambda: spark.read.parquet(paths["zones"]),
    }
    found = {name: read[name]() for name in SOURCES if paths.get(name)}
    found.setdefault("countries", plan.countries(spark))
    return plan.Inputs(**found)


def build(spark: SparkSession, paths: dict[str, str], out: str, force: bool = False, lookup_file: str | None = None) -> str:
    """Runs a build into the folder ``out`` (csv, parquet, previous, sources); 'unchanged' or 'built'."""
    with locked(spark, f"{out}/.lock"):
        now = readers.manifest(spark, sorted(p for p in paths.values() if p))
        if not force and exists(spark, f"{out}/sources") and exists(spark, f"{out}/csv"):
            before = spark.read.parquet(f"{out}/sources")
            if not readers.changed(before, now).head(1) and before.count() == now.count():
                return "unchanged"
        snapshot(spark, f"{out}/csv", f"{out}/previous")
        release = plan.build(inputs(spark, paths), time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())).checkpoint()
        plan.write_csv(release, f"{out}/csv")
        plan.write_parquet(release, f"{out}/parquet")
        if lookup_file:
            mmdb.write(plan.nested(release), lookup_file, built=int(time.time()))
        now.write.mode("overwrite").parquet(f"{out}/sources")
        return "built"


def smoke(release: DataFrame, data: bytes, n: int = 25) -> tuple[bool, str]:
    """Looks the first addresses of a release up in a lookup file: each must have a record with a location. A
    release without any address does not pass."""
    file, checked = mmdb.File(data), 0
    for (prefix,) in quality.smoke_sample(release, n).collect():
        record = mmdb.lookup(file, mmdb._prefix(prefix)[0])
        if not record:
            return False, f"no record for {prefix}"
        if not isinstance(record.get("location"), dict) or not record["location"]:
            return False, f"no location for {prefix}"
        checked += 1
    return checked > 0, f"lookups OK ({checked} addresses)"


def check(spark: SparkSession, current: str, previous: str, lookup_file: str, report: str, strict: bool = False) -> int:
    """Writes the report; 0, 1 (lookups fail) or 2 (worse than before, if strict)."""
    now = quality.load_release(readers.release_csv(spark, current))
    before = diff = None
    cover, cover_before = quality.coverage(now), None
    if exists(spark, previous):
        before = quality.load_release(readers.release_csv(spark, previous))
        cover_before, diff = quality.coverage(before), quality.difference(before, now)
    try:
        with open(lookup_file, "rb") as f:
            ok, said = smoke(now, f.read())
    except (OSError, ValueError) as e:
        ok, said = False, str(e)
    with open(report, "w", encoding="utf-8") as f:
        f.write(quality.report(cover, cover_before, diff) + f"lookup file: {said}\n")
    if not ok:
        return 1
    return 2 if strict and quality.regressed(cover, cover_before, diff).first()[0] else 0


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="blockfuse")
    commands = parser.add_subparsers(dest="command", required=True)
    b = commands.add_parser("build")
    for name in SOURCES:
        b.add_argument(f"--{name}", required=name == "seed")
    b.add_argument("--out", required=True)
    b.add_argument("--lookup-file")
    b.add_argument("--force", action="store_true")
    c = commands.add_parser("check")
    for name in ("current", "previous", "lookup-file", "report"):
        c.add_argument(f"--{name}", required=True)
    c.add_argument("--strict", action="store_true")
    a = parser.parse_args(args)
    spark = spark or SparkSession.builder.appName("blockfuse").getOrCreate()
    if a.command == "build":
        print(build(spark, {name: getattr(a, name) for name in SOURCES if getattr(a, name)}, a.out, a.force, a.lookup_file))
        return 0
    return check(spark, a.current, a.previous, a.lookup_file, a.report, a.strict)
