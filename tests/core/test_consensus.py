import random

from model import merge
from pyspark.sql import functions as F

from blockfuse.operators import consensus

SHAPE = f"id int, country string, candidates array<{consensus.CANDIDATE}>"
FIELDS = ("source", "country", "state", "city", "ru", "postal", "lat", "lon", "has")


def run(spark, cases):
    rows = [(i, country, [tuple(c[f] for f in FIELDS) for c in cands]) for i, (country, cands) in enumerate(cases)]
    out = consensus.merge(spark.createDataFrame(rows, SHAPE)).orderBy("id").select("merged.*").collect()
    return [{k: r[k] for k in ("country", "state", "city", "postal", "lat", "lon", "sources", "confidence")} for r in out]


def opinion(source, country="RU", state="", city="", ru="", postal="", lat=0.0, lon=0.0, has=None):
    return dict(source=source, country=country, state=state, city=city, ru=ru, postal=postal, lat=lat, lon=lon, has=bool(lat or lon) if has is None else has)


def random_case(rnd):
    country = rnd.choice(["RU", "US", "DE", "XX", "JP", ""])
    out = []
    for source in ("dbip", "geofeed", "maxmind", "ip2loc", "sypex"):
        if rnd.random() < 0.75:
            lat, lon = rnd.choice([(0, 0), (55.75, 37.62), (55.9, 37.4), (56.5, 38.0), (60.0, 100.0), (51.0, 9.0), (95.0, 3.0), (0.001, 0.002), (40.7, -74.0), (52.0, 13.0)])
            out.append(
                opinion(
                    source, rnd.choice([country, "", "US"]), rnd.choice(["", "Moscow Oblast", "Moscow", "n/a", "Bayern", "Bavaria"]),
                    rnd.choice(["", "Moscow", "Moskva", "Saint-Petersburg", "St. Petersburg", "New York", "New York City", "-", "München"]),
                    rnd.choice(["", "", "Москва", "Санкт-Петербург", "Щёлково"]), rnd.choice(["", "101000", "101 000", "101999", "000", "80331"]),
                    float(lat), float(lon),
                )
            )
    return country, out


def test_random_cases_equal_the_model(spark):
    rnd = random.Random(11)
    cases = [random_case(rnd) for _ in range(1500)] + [("US", [])]
    got = run(spark, cases)
    for (country, cands), g in zip(cases, got, strict=True):
        assert g == merge(cands, country), (country, cands)


def test_a_chain_is_one_group_and_ties_go_to_trust(spark):
    a = opinion("dbip", city="Alpha", lat=55.0, lon=37.0)
    far = opinion("maxmind", city="Omega", lat=58.0, lon=44.0)
    cases = [("RU", [a, far]), ("RU", [dict(a, country="US"), far]), ("RU", [opinion("dbip", state="only a state")])]
    got = run(spark, cases)
    assert [g["city"] for g in got] == ["Alpha", "Omega", ""]
    assert got[2]["confidence"] == 0 and got[2]["sources"] == []


def test_centroid_of_the_primary_leaks_and_blocks_donation(spark):
    p = opinion("geofeed", city="Moscow", lat=55.75, lon=37.62)
    q = opinion("maxmind", city="Moscow", lat=55.9, lon=37.4)
    (g,) = run(spark, [("RU", [p, q])])
    assert (g["lat"], g["lon"]) == (55.75, 37.62)


def test_no_python_and_no_shuffle_in_the_plan(spark):
    df = consensus.merge(spark.createDataFrame([], SHAPE))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert df.agg(F.count("*")).first()[0] == 0
