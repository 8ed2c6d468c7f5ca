import random

import pytest
from pyspark.sql import functions as F

from blockfuse.operators import joins, quality
from blockfuse.plans import build as plan
from blockfuse.plans import catalog
from blockfuse.sources import mmdb, readers
from blockfuse.streaming import enrich_stream

SF = "/root/testdata/sf0.001"


def lines(spark, rows):
    return spark.createDataFrame([("f", i, r) for i, r in enumerate(rows)], "file string, line long, value string")


def test_seed_file(spark, tmp_path):
    p = tmp_path / "seed.csv"
    p.write_text("1.0.0.0,1.0.0.255,AS,CN,Fujian,Fuzhou,26.06,119.3\n::,::1,EU,DE,,,1,1\n1.0.1.0,1.0.1.9,AS,CN,,,x,\n")
    got = [tuple(r) for r in readers.seed(spark, str(p)).orderBy("ip_start").collect()]
    assert got == [(16777216, 16777471, "CN", "Fujian", "Fuzhou", 26.06, 119.3, True), (16777472, 16777481, "CN", "", "", 0.0, 0.0, False)]
    p.write_text("1.0.0.0,1.0.0.255,AS,CN,a,b,1,2\n1.0.1.0,ragged\n1.0.2.0,1.0.2.1,AS,CN,a,b,1,2\n")
    assert readers.seed(spark, str(p), "skip").count() == 2
    assert readers.seed(spark, str(p), "truncate").count() == 1
    with pytest.raises(Exception):
        readers.seed(spark, str(p)).collect()


def test_geofeed_rows(spark):
    rows = lines(spark, ["# comment", "10.0.0.5/24, us , CA,Los Angeles, 90001", '10.1.0.0/16,DE,,"Berlin, Mitte",', "10.0.0.0/25,US,a,b", "::/8,US,a,b", "1.1.1.0/24,US"])
    got = [tuple(r) for r in readers.geofeed_rows(rows).orderBy("ip_start").drop("file", "line").collect()]
    assert got == [(167772165, 24, "US", "CA", "Los Angeles", "90001", 167772415), (167837696, 16, "DE", "", "Berlin, Mitte", "", 167903231)]


def test_registry_rows(spark):
    rows = lines(spark, ["2|arin|x", "arin|US|ipv4|10.0.0.0|256|20000101|allocated", "arin|zz|ipv4|10.1.0.0|256|x|y", "ripe|de|ipv4|255.255.255.0|512|x|y", "ripe|DE|ipv6|::|32|x|y"])
    got = [tuple(r) for r in readers.delegation_rows(rows).orderBy("ip_start").select("cc", "ip_start", "ip_end").collect()]
    assert got == [("US", 167772160, 167772415), ("DE", 4294967040, 255)]


def test_geonames_rows(spark):
    p = lines(spark, ["ca\tH2X 1A1\tMontreal (Montreal-Est)\tQuebec\tQC\t\t\t\t\t45.5\t-73.5\t1", "us\t\tNowhere\tX\tX\t\t\t\t\t1\t1\t1"])
    assert [tuple(r)[1:] for r in readers.postal_rows(p).collect()] == [("CA", "H2X 1A1", "Montreal (Montreal-Est)", "Quebec", 45.5, -73.5)]
    g = lines(spark, ["\t".join(["7", "Köln", "Koeln", "Cologne,Colonia", "1", "2", c, "PPL", "de", "", "", "", "", "", "900"]) for c in "PA"])
    assert [tuple(r)[1:] for r in readers.gazetteer_rows(g).collect()] == [(7, "Köln", "Koeln", "Cologne,Colonia", "DE", 900)]


def test_manifest_changes(spark, tmp_path):
    (tmp_path / "a").write_text("one")
    (tmp_path / "b").write_text("two")
    old = spark.createDataFrame(readers.manifest(spark, str(tmp_path)).collect(), "path string, length long, sha256 string")
    (tmp_path / "b").write_text("three")
    assert [r[0][-1] for r in readers.changed(old, readers.manifest(spark, str(tmp_path))).collect()] == ["b"]


def test_joins_plan_without_nested_loops(spark):
    for name in ("lpm_geofeed_join", "asof_registry_join", "donor_range_join"):
        plan_text = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan_text and "Cartesian" not in plan_text and "Python" not in plan_text


def test_as_of_uses_the_last_start_only(spark):
    rnd = random.Random(3)
    ranges = [(s := rnd.randrange(2000), s + rnd.randrange(300), f"c{i}", "f", i) for i in range(80)]
    addr = list(range(0, 2400, 7))
    r = spark.createDataFrame(ranges, "ip_start long, ip_end long, cc string, file string, line long")
    a = spark.createDataFrame([(x,) for x in addr], "addr long")
    got = {x.addr: x.cc for x in joins.as_of_range(a, r, ["cc"], ["file", "line"]).collect()}
    for x in addr:
        before = [q for q in ranges if q[0] <= x]
        last = max(before, key=lambda q: (q[0], q[4]), default=None)
        assert got.get(x) == (last[2] if last and x <= last[1] else None)


def test_release_file_round_trip_and_gate(spark, tmp_path):
    release = plan.build(plan.Inputs(seed=readers.seed_rows(spark.createDataFrame([("9.0.0.0", "9.0.1.255", "EU", "DE", "", "Berlin", "52.5", "13.4")], readers.SEED))), "now")
    plan.write_csv(release, str(tmp_path / "r"))
    back = quality.load_release(readers.release_csv(spark, str(tmp_path / "r")))
    (row,) = back.collect()
    assert (row.matched_prefix, row.city_name, row.latitude, row.confidence) == ("9.0.0.0/23", "Berlin", "52.50000", 40)
    cov = quality.coverage(back)
    assert not quality.regressed(cov).first()[0]
    worse = back.withColumn("city_name", F.lit("Kazan’"))
    assert quality.regressed(quality.coverage(worse), cov, quality.difference(back, worse)).first()[0]
    assert "rows: 1" in quality.report(cov, cov, quality.difference(back, back))


def test_mmdb_round_trip(spark, tmp_path):
    rows = [("10.0.0.0/8", 1, "wide"), ("10.1.0.0/16", 2, "é" * 400), ("10.1.2.3/32", 3, ""), ("0.0.0.0/32", 4, "x")]
    df = spark.createDataFrame(rows, "matched_prefix string, n long, s string").withColumn("f", F.lit(1.5)).withColumn("b", F.lit(True))
    path = str(tmp_path / "x.mmdb")
    assert mmdb.write(df, path) == 4
    data = open(path, "rb").read()
    at = lambda a, b, c, d: mmdb.lookup(data, (a << 24) | (b << 16) | (c << 8) | d)
    assert [at(10, 0, 0, 1)["n"], at(10, 1, 2, 3)["n"], at(10, 1, 2, 4)["s"], at(0, 0, 0, 0)["n"]] == [1, 3, "é" * 400, 4]
    assert at(11, 0, 0, 0) is None and at(10, 0, 0, 1) == {"matched_prefix": "10.0.0.0/8", "n": 1, "s": "wide", "f": 1.5, "b": True}
    flat = mmdb.rows(spark, path, "n long, s string")
    assert flat.agg(F.sum(F.expr("ip_end - ip_start + 1"))).first()[0] == (1 << 24) + 1
    hit = joins.point_in_range(spark.createDataFrame([((10 << 24) + (1 << 16),)], "addr long"), flat, ["n"])
    assert hit.first().n == 2


def as_ipv6(v4: bytes, size: int) -> bytes:
    """An IPv4 file of 32-bit records as an IPv6 tree (96 nodes on top) with records of another size."""
    file, top = mmdb.File(v4), 96
    n = file.n + top
    moved = lambda x: x + top if x != file.n else n
    nodes = [(k + 1, n) for k in range(top)] + [tuple(map(moved, file.children(k))) for k in range(file.n)]
    out = b""
    for a, b in nodes:
        if size == 28:
            out += (a & 0xFFFFFF).to_bytes(3, "big") + bytes([(a >> 24) << 4 | b >> 24]) + (b & 0xFFFFFF).to_bytes(3, "big")
        else:
            out += a.to_bytes(size // 8, "big") + b.to_bytes(size // 8, "big")
    data = v4[file.n * 8 : v4.rindex(b"\xab\xcd\xefMaxMind.com")]
    return out + data + b"\xab\xcd\xefMaxMind.com" + mmdb.encode(file.about | {"node_count": n, "record_size": size, "ip_version": 6})


@pytest.mark.parametrize("size", [24, 28, 32])
def test_mmdb_ipv6_trees(spark, tmp_path, size):
    blocks = [("10.0.0.0/8", 1), ("10.1.0.0/16", 2), ("192.168.0.0/24", 3), ("0.0.0.0/32", 4), ("255.255.255.255/32", 5)]
    path = tmp_path / "x.mmdb"
    mmdb.write(spark.createDataFrame(blocks, "matched_prefix string, n long"), str(path))
    v4 = path.read_bytes()
    v6 = as_ipv6(v4, size)
    assert [(a, b, r["n"]) for a, b, r in mmdb.entries(v6)] == [(a, b, r["n"]) for a, b, r in mmdb.entries(v4)]
    for text_, want in (("10.0.0.1", 1), ("10.1.2.3", 2), ("192.168.0.9", 3), ("0.0.0.0", 4), ("255.255.255.255", 5), ("11.0.0.0", None)):
        a, b, c, d = map(int, text_.split("."))
        got = mmdb.lookup(v6, (a << 24) | (b << 16) | (c << 8) | d)
        assert (got and got["n"]) == want
    path.write_bytes(v6)
    assert mmdb.rows(spark, str(path), "n long").count() == len(list(mmdb.entries(v4)))


def test_release_csv_doubles_quotes(spark, tmp_path):
    df = spark.createDataFrame([('a"b', 'x, "y"', ""), ("c", "d", "e")], "p string, q string, r string")
    df.coalesce(1).write.options(header="true", quote='"', escape='"', emptyValue="").csv(str(tmp_path / "r"))
    (part,) = (tmp_path / "r").glob("*.csv")
    import csv

    assert list(csv.reader(part.open()))[1:] == [['a"b', 'x, "y"', ""], ["c", "d", "e"]]
    assert ',""\n' not in part.read_text()
    back = readers.release_csv(spark, str(tmp_path / "r")).orderBy("line").select("p", "q").collect()
    assert [tuple(r) for r in back] == [('a"b', 'x, "y"'), ("c", "d")]


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    """A copy without the two folders (and without the pipeline, or with it) still gives all core queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    for name in ("blockfuse", "__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).exists():
            (shutil.copytree if (root / name).is_dir() else shutil.copy)(root / name, tmp_path / name)
    shutil.rmtree(tmp_path / "blockfuse" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert len(q) > 40 and set(s) <= set(q); assert not any(n.startswith('op') or n == 'pipeline' for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""})
    (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""})


def test_stream_enrichment(spark, tmp_path):
    release = spark.createDataFrame([("10.0.0.0/8", "A"), ("10.1.0.0/16", "B")], "matched_prefix string, country_code string")
    rows = spark.createDataFrame([("10.1.2.3",), ("10.2.0.0",), ("11.0.0.0",), ("bad",)], "ip string")
    rows.write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("ip string").json(str(tmp_path / "in"))
    q = enrich_stream.start(stream, release, "ip", ["country_code"], str(tmp_path / "out"), str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    got = {r.ip: r.country_code for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"10.1.2.3": "B", "10.2.0.0": "A", "11.0.0.0": None, "bad": None}


def test_country_table(spark):
    rows = {r.country_code: r for r in plan.countries(spark).collect()}
    assert rows["DE"].country_name == "Germany" and rows["DE"].currency_code == "EUR" and len(rows) > 200
