import csv
import zipfile

import pytest

from blockfuse.plans import runner
from blockfuse.sources import mmdb

from test_points import ROWS, bin_file, sx_file


@pytest.fixture
def files(spark, tmp_path):
    """One small file of each source."""
    (tmp_path / "seed.csv").write_text('1.0.0.0,1.0.0.255,OC,AU,,,0,0\n2.0.0.0,2.0.0.255,EU,RU,"St ""X""","a, b",55.0,37.0\n9.0.0.0,9.0.1.255,EU,DE,,Berlin,52.5,13.4\n')
    (tmp_path / "feed.csv").write_text("# feed\n9.0.0.0/24,DE,,Berlin,10115\n")
    (tmp_path / "delegated").write_text("ripe|FR|ipv4|9.0.1.0|256|20000101|allocated\n")
    with zipfile.ZipFile(tmp_path / "postal.zip", "w") as z:
        z.writestr("readme.md", "no")
        z.writestr("all.txt", "DE\t10115\tBerlin\tBerlin\tBE\t\t\t\t\t52.53\t13.38\t1\nAU\t4000\tBrisbane\tQueensland\tQL\t\t\t\t\t-27.47\t153.02\t1\n")
    (tmp_path / "cities.txt").write_text("\t".join(["5", "Berlin", "Berlin", "", "1", "2", "P", "PPL", "DE", "", "", "", "", "", "900"]) + "\n")
    (tmp_path / "points.bin").write_bytes(bin_file(11, ROWS))
    (tmp_path / "sx.dat").write_bytes(sx_file())
    nested = "matched_prefix string, " + runner.MAXMIND
    rows = [("9.0.0.0/8", ({"en": "Berlin"},), ("DE",), [({"en": "Berlin State"},)], ("10115",), (52.52, 13.4))]
    mmdb.write(spark.createDataFrame(rows, nested), str(tmp_path / "mm.mmdb"))
    names = {"seed": "seed.csv", "geofeed": "feed.csv", "registry": "delegated", "postal": "postal.zip", "gazetteer": "cities.txt", "ip2loc": "points.bin", "sypex": "sx.dat", "maxmind": "mm.mmdb"}
    return {k: str(tmp_path / v) for k, v in names.items()}


def test_build_and_check(spark, tmp_path, files):
    out, lookup, report = str(tmp_path / "out"), str(tmp_path / "geo.mmdb"), str(tmp_path / "report.txt")
    args = [x for k, v in files.items() for x in (f"--{k}", v)]
    assert runner.main(["build", *args, "--out", out, "--lookup-file", lookup], spark) == 0
    rows = {r["matched_prefix"]: r for part in (tmp_path / "out/csv").glob("*.csv") for r in csv.DictReader(part.open())}
    berlin = rows["9.0.0.0/23"]
    assert (berlin["city_name"], berlin["postal_code"], berlin["city_geoname_id"], berlin["country_name"]) == ("Berlin", "10115", "5", "Germany")
    assert rows["1.0.0.0/24"]["city_name"] == "Brisbane" and rows["2.0.0.0/24"]["country_code"] == "RU"
    check = ["check", "--current", f"{out}/csv", "--previous", f"{out}/previous", "--lookup-file", lookup, "--report", report]
    assert runner.main(check, spark) == 0 and runner.main([*check, "--strict"], spark) == 0
    assert "lookups OK (3 addresses)" in open(report).read()
    assert runner.build(spark, files, out) == "unchanged"
    with open(files["seed"], "a") as f:
        f.write("20.0.0.0,20.0.0.255,EU,FR,,Paris,48.8,2.3\n")
    with open(files["seed"]) as f:
        text = f.read()
    with open(files["seed"], "w") as f:
        f.write(text.replace("Berlin", "Kazan’x"))
    assert runner.build(spark, files, out, lookup_file=lookup) == "built" and runner.exists(spark, f"{out}/previous")
    assert runner.main([*check, "--strict"], spark) in (0, 2)
    assert runner.main([*check[:5], "--lookup-file", str(tmp_path / "none"), "--report", report, "--strict"], spark) == 1


def test_strict_check_of_a_worse_release(spark, tmp_path, files):
    lookup = str(tmp_path / "geo.mmdb")
    for name, city in (("previous", "Berlin"), ("current", "Ber�lin")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_text(
            "start_ip,matched_prefix,country_code,country_name,registry_country_code,subdivision_name,city_name,postal_code,city_geoname_id,latitude,longitude,confidence\n"
            f"9.0.0.0,9.0.0.0/24,DE,Germany,DE,,{city},10115,5,52.5,13.4,80\n"
        )
    mmdb.write(spark.createDataFrame([("9.0.0.0/24", ("DE",))], "matched_prefix string, location struct<country_code:string>"), lookup)
    go = lambda strict: runner.check(spark, str(tmp_path / "current"), str(tmp_path / "previous"), lookup, str(tmp_path / "r"), strict)
    assert go(False) == 0 and go(True) == 2
    mmdb.write(spark.createDataFrame([("9.0.0.0/24", 1)], "matched_prefix string, n int"), lookup)
    assert go(True) == 1


def test_lock_and_smoke_of_nothing(spark, tmp_path):
    with runner.locked(spark, str(tmp_path / "lock")):
        with pytest.raises(RuntimeError):
            with runner.locked(spark, str(tmp_path / "lock")):
                pass
    with runner.locked(spark, str(tmp_path / "lock")):
        pass
    path = str(tmp_path / "e.mmdb")
    mmdb.write(spark.createDataFrame([("1.0.0.0/24", 1)], "matched_prefix string, n int"), path)
    empty = spark.createDataFrame([], "matched_prefix string")
    assert runner.smoke(empty, open(path, "rb").read()) == (False, "lookups OK (0 addresses)")


def test_index_counts(spark):
    p = spark.createDataFrame([("DE", "1"), ("DE", "1"), ("FR", "1")], "country string, postal string")
    g = spark.createDataFrame([("DE", "a"), ("DE", "b"), ("DE", "a")], "country string, name string")
    assert runner.index_counts(p, g) == {"gazetteer_rows": 3, "cities": 2, "postal_rows": 3, "codes": 2}
