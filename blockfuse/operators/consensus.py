"""Consensus over the opinions on a block: one projection over an array of candidates, no shuffle.

A candidate is struct<source, country, state, city, city_ru, postal, lat, lon, has_coords>. Absent text is
''. Fields of the result come from the primary candidate, then from donors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, geo, text

CANDIDATE = (
    "struct<source:string,country:string,state:string,city:string,city_ru:string,postal:string,"
    "lat:double,lon:double,has_coords:boolean>"
)
HIGH, GOOD, MODERATE, WEAK, CONFLICT = 4, 3, 2, 1, 0


@dataclass(frozen=True)
class Config:
    """Weights of the match score and the trust that lets an outsider fill a field."""

    geo: float = 0.35
    name: float = 0.30
    postal: float = 0.20
    state: float = 0.15
    fill_trust: int = 50
    min_confidence: int = 0


DEFAULT = Config()


def candidate(source: str, country, state, city, city_ru, postal, lat, lon, has_coords) -> Column:
    text_of = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.struct(
        F.lit(source).alias("source"),
        text_of(country).alias("country"),
        text_of(state).alias("state"),
        text_of(city).alias("city"),
        text_of(city_ru).alias("city_ru"),
        text_of(postal).alias("postal"),
        F.coalesce(lat.cast("double"), F.lit(0.0)).alias("lat"),
        F.coalesce(lon.cast("double"), F.lit(0.0)).alias("lon"),
        F.coalesce(has_coords, F.lit(False)).alias("has_coords"),
    )


def scrubbed(c: Column) -> Column:
    """The candidate without placeholders, and with keys that later steps compare."""
    return F.struct(
        c["source"].alias("source"),
        c["country"].alias("country"),
        text.scrub(c["state"]).alias("state"),
        text.scrub(c["city"]).alias("city"),
        text.scrub(c["city_ru"]).alias("city_ru"),
        text.scrub_postal(c["postal"]).alias("postal"),
        c["lat"].alias("lat"),
        c["lon"].alias("lon"),
        c["has_coords"].alias("has_coords"),
    )


def checked(c: Column, country: Column) -> Column:
    """The scrubbed candidate with trust; coordinates that cannot be are cleared. A country's centroid
    loses has_coords but keeps its numbers."""
    zero = geo.null_island(c["lat"], c["lon"])
    out = ~zero & geo.out_of_range(c["lat"], c["lon"])
    lost = c["has_coords"] & (zero | out)
    usable = c["has_coords"] & ~zero & ~out
    outside = usable & (country != "") & ~geo.in_country_box(country, c["lat"], c["lon"])
    centroid = usable & geo.is_country_centroid(country, c["lat"], c["lon"])
    keeps = usable & ~centroid
    trust = (
        F.lit(100)
        - F.when((c["country"] != "") & (country != "") & (c["country"] != country), 40).otherwise(0)
        - F.when(c["has_coords"] & zero, 25).otherwise(0)
        - F.when(c["has_coords"] & out, 30).otherwise(0)
        - F.when(outside, 20).otherwise(0)
        - F.when(centroid, 15).otherwise(0)
    )
    nothing = (c["city"] == "") & (c["city_ru"] == "") & (c["postal"] == "") & ~keeps
    return F.struct(
        *[c[f].alias(f) for f in ("source", "country", "state", "city", "city_ru", "postal")],
        F.when(lost, 0.0).otherwise(c["lat"]).alias("lat"),
        F.when(lost, 0.0).otherwise(c["lon"]).alias("lon"),
        keeps.alias("has_coords"),
        F.when(nothing, 0).otherwise(F.greatest(trust, F.lit(0))).alias("trust"),
    )


def keyed(c: Column) -> Column:
    """With normalised names, so that each is computed once for all pairs."""

    # one lambda for both names, so that the expression stays small
    names = F.transform(
        F.transform(F.array(c["city"], c["city_ru"]), text.normalize_name),
        lambda n: F.struct(
            n.alias("n"),
            text.contains_cyrillic(n).alias("cyr"),
            F.when(text.contains_cyrillic(n), text.transliterate(n)).alias("tr"),
            F.when(text.contains_cyrillic(n), text.known_latin(n)).alias("known"),
        ),
    )
    return F.struct(
        *[c[f].alias(f) for f in ("source", "country", "state", "city", "city_ru", "postal", "lat", "lon", "has_coords", "trust")],
        names[0].alias("k_en"),
        names[1].alias("k_ru"),
        text.normalize_name(c["state"]).alias("k_state"),
        text.normalize_postal(c["postal"]).alias("k_postal"),
    )


def pair_score(a: Column, b: Column) -> Column:
    """Score of two names with their keys (struct n, cyr, tr, known)."""
    same_script = a["cyr"] == b["cyr"]
    translit = F.when(a["cyr"], a["tr"]).otherwise(b["tr"])
    known = F.when(a["cyr"], a["known"]).otherwise(b["known"])
    latin = F.when(a["cyr"], b["n"]).otherwise(a["n"])
    d = text.levenshtein_norm(a["n"], b["n"])
    dt = text.levenshtein_norm(translit, latin)
    inside = (F.octet_length(a["n"]) >= 4) & (F.octet_length(b["n"]) >= 4) & (a["n"].contains(b["n"]) | b["n"].contains(a["n"]))
    return (
        F.when((a["n"] == "") | (b["n"] == ""), 0)
        .when(a["n"] == b["n"], 100)
        .when(~same_script & F.coalesce(known == latin, F.lit(False)), 100)
        .when(~same_script & (translit == latin), 95)
        .when(~same_script, F.when(dt >= 88, dt - 5).otherwise(0))
        .when(d >= 90, d)
        .when(inside, 80)
        .when(d >= 70, d - 5)
        .otherwise(0)
    )


def name_score(a: Column, b: Column) -> Column:
    """The best of the four pairings of names; a side without a name scores 0."""
    pairs = [(a["k_en"], b["k_en"]), (a["k_ru"], b["k_ru"]), (a["k_en"], b["k_ru"]), (a["k_ru"], b["k_en"])]
    # one lambda for the four, so that the expression stays small
    every = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in pairs])
    return F.array_max(F.transform(every, lambda p: pair_score(p["x"], p["y"])))


def state_score(na: Column, nb: Column) -> Column:
    d = text.levenshtein_norm(na, nb)
    return (
        F.when((na == "") | (nb == ""), -1)
        .when(na == nb, 100)
        .when(na.contains(nb) | nb.contains(na), 85)
        .when(d >= 80, d)
        .otherwise(0)
    )


def postal_score(pa: Column, pb: Column) -> Column:
    """Of normalised codes."""
    alike = (F.octet_length(pa) >= 3) & (F.octet_length(pb) >= 3) & (text.byte_prefix(pa, 3) == text.byte_prefix(pb, 3))
    return F.when(pa == pb, 100).when(alike, 60).otherwise(0)


def total_score(geo_, name, postal, state, named: Column, cfg: Config = DEFAULT) -> Column:
    """Weighted mean of the dimensions that apply, rounded half away from zero; geo always applies."""
    total, weight = geo_ * F.lit(cfg.geo), F.lit(cfg.geo)
    for score, w, on in ((name, cfg.name, named & (name >= 0)), (postal, cfg.postal, postal >= 0), (state, cfg.state, state >= 0)):
        total = total + F.when(on, score * F.lit(w)).otherwise(0.0)
        weight = weight + F.when(on, F.lit(w)).otherwise(0.0)
    return F.floor(total / weight + 0.5).cast("int")


def agreement(total: Column) -> Column:
    return F.when(total >= 80, HIGH).when(total >= 60, GOOD).when(total >= 40, MODERATE).when(total >= 20, WEAK).otherwise(CONFLICT)


def match(a: Column, b: Column, cfg: Config = DEFAULT) -> Column:
    """struct<geo, name, postal, state, total, agreement> of two keyed candidates; -1: does not apply."""
    km = geo.haversine_km(a["lat"], a["lon"], b["lat"], b["lon"])
    near = F.when(a["has_coords"] & b["has_coords"], geo.proximity(km)).otherwise(50)
    postal = F.when((a["postal"] != "") & (b["postal"] != ""), postal_score(a["k_postal"], b["k_postal"])).otherwise(-1)
    state = F.when((a["state"] != "") & (b["state"] != ""), state_score(a["k_state"], b["k_state"])).otherwise(-1)
    named = ((a["city"] != "") | (a["city_ru"] != "")) & ((b["city"] != "") | (b["city_ru"] != ""))
    scores = F.struct(
        near.alias("geo"), name_score(a, b).alias("name"), postal.alias("postal"), state.alias("state"), named.alias("named")
    )
    # bound once, so that the total does not compute the parts again
    return F.transform(
        F.transform(
            F.array(scores),
            lambda s: F.struct(*[s[f].alias(f) for f in ("geo", "name", "postal", "state")], total_score(s["geo"], s["name"], s["postal"], s["state"], s["named"], cfg).alias("total")),
        ),
        lambda s: F.struct(*[s[f].alias(f) for f in ("geo", "name", "postal", "state", "total")], agreement(s["total"]).alias("agreement")),
    )[0]


def rank(source: Column, country: Column) -> Column:
    def position(order):
        at = F.array_position(F.array(*[F.lit(s) for s in order]), source)
        return F.when(at > 0, at - 1).otherwise(fixed.UNRANKED).cast("int")

    cis, asia = country.isin(*fixed.CIS), country.isin(*fixed.ASIA)
    return F.when(cis, position(fixed.PRIORITY_CIS)).when(asia, position(fixed.PRIORITY_ASIA)).otherwise(position(fixed.PRIORITY_DEFAULT))


def component(adjacent: Column, trusts: Column) -> Column:
    """0-based members, in the order of discovery, of the winning connected component of a small graph:
    the largest, then the most trusted, then the one with the lowest first member.

    ``adjacent``: array of arrays of 0-based neighbours in ascending order."""
    n = F.size(adjacent)

    def discovered(start):
        step = lambda acc, k: F.when(F.size(acc) > k, F.concat(acc, F.array_except(F.get(adjacent, F.get(acc, k)), acc))).otherwise(acc)
        return F.aggregate(F.sequence(F.lit(0), n - 1), F.array(start), step)

    found = F.transform(F.sequence(F.lit(0), n - 1), discovered)
    firsts = F.filter(found, lambda c: F.get(c, F.lit(0)) == F.array_min(c))
    trust = lambda c: F.aggregate(c, F.lit(0), lambda a, i: a + F.get(trusts, i))
    ranked = F.transform(
        firsts, lambda c: F.struct(F.size(c).alias("n"), trust(c).alias("t"), (-F.get(c, F.lit(0))).alias("i"), c.alias("c"))
    )
    return F.array_max(ranked)["c"]


def merge(df: DataFrame, candidates: str = "candidates", country: str = "country", cfg: Config = DEFAULT) -> DataFrame:
    """``df`` with a struct column ``merged``: country, state, city, postal, lat, lon, confidence, sources,
    n_valid, n_cluster."""
    seed = F.col(country)
    kept = [c for c in df.columns if not c.startswith("__c_")]
    df = df.withColumn("__c_scrub", F.transform(F.coalesce(candidates, F.array().cast(f"array<{CANDIDATE}>")), scrubbed))
    df = df.withColumn("__c_valid", F.filter(F.transform("__c_scrub", lambda c: checked(c, seed)), lambda c: c["trust"] > 0))
    df = df.withColumn("__c_keyed", F.transform("__c_valid", keyed))
    v, n = F.col("__c_keyed"), F.size("__c_keyed")
    everyone = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    # pairs i < j once; the graph is symmetric
    pairs = F.flatten(
        F.transform(
            everyone,
            lambda i: F.transform(
                F.filter(everyone, lambda j: j > i),
                lambda j: F.struct(i.alias("i"), j.alias("j"), match(F.get(v, i), F.get(v, j), cfg).alias("s")),
            ),
        )
    )
    df = df.withColumn("__c_pairs", pairs)
    good = lambda i: F.sort_array(
        F.transform(
            F.filter("__c_pairs", lambda p: (p["s"]["agreement"] >= GOOD) & ((p["i"] == i) | (p["j"] == i))),
            lambda p: F.when(p["i"] == i, p["j"]).otherwise(p["i"]),
        )
    )
    df = df.withColumn("__c_graph", F.transform(everyone, good))
    df = df.withColumn("__c_members", F.when(n > 0, component(F.col("__c_graph"), F.transform(v, lambda c: c["trust"]))))
    members = F.col("__c_members")
    df = df.withColumn(
        "__c_first",
        F.array_min(
            F.transform(
                members, lambda i, pos: F.struct(rank(F.get(v, i)["source"], seed).alias("r"), (-F.get(v, i)["trust"]).alias("t"), pos.alias("p"), i.alias("i"))
            )
        )["i"],
    )
    p, at = F.get(v, F.col("__c_first")), F.col("__c_first")
    df = df.withColumn("__c_primary", p)
    p = F.col("__c_primary")
    score_of = lambda i: F.get(
        F.filter("__c_pairs", lambda q: ((q["i"] == i) & (q["j"] == at)) | ((q["j"] == i) & (q["i"] == at))), F.lit(0)
    )["s"]
    donor = lambda i: F.struct(
        F.get(v, i)["source"].alias("source"), F.get(v, i)["state"].alias("state"), F.get(v, i)["city"].alias("city"),
        F.get(v, i)["postal"].alias("postal"), F.get(v, i)["lat"].alias("lat"), F.get(v, i)["lon"].alias("lon"),
        F.get(v, i)["has_coords"].alias("has_coords"), score_of(i)["agreement"].alias("level"), score_of(i)["state"].alias("state_match"),
    )
    df = df.withColumn("__c_donors", F.transform(F.filter(members, lambda i: F.get(v, i)["source"] != p["source"]), donor))
    sources_in = F.transform(members, lambda i: F.get(v, i)["source"])
    df = df.withColumn("__c_others", F.filter("__c_valid", lambda c: ~F.array_contains(sources_in, c["source"])))

    first = lambda array, cond: F.get(F.filter(array, cond), F.lit(0))
    d, o, trusted = F.col("__c_donors"), F.col("__c_others"), lambda c: c["trust"] >= cfg.fill_trust
    gives = {
        "city": lambda c: (c["level"] >= GOOD) & (c["city"] != ""),
        "state": lambda c: (c["level"] >= MODERATE) & (c["state"] != ""),
        "postal": lambda c: (c["postal"] != "") & ((c["level"] >= GOOD) | ((c["level"] == MODERATE) & (c["state_match"] > 50))),
        "coords": lambda c: (c["level"] >= GOOD) & c["has_coords"],
    }
    no_coords = (p["lat"] == 0) & (p["lon"] == 0)
    # the donor of each field, if the primary lacks it
    df = df.withColumn(
        "__c_from",
        F.struct(
            F.when(p["city"] == "", first(d, gives["city"])).alias("city"),
            F.when(p["state"] == "", first(d, gives["state"])).alias("state"),
            F.when(p["postal"] == "", first(d, gives["postal"])).alias("postal"),
            F.when(no_coords, first(d, gives["coords"])).alias("coords"),
        ),
    )
    g = F.col("__c_from")
    df = df.withColumn(
        "__c_fill",
        F.struct(
            F.when((p["postal"] == "") & g["postal"].isNull(), first(o, lambda c: trusted(c) & (c["postal"] != ""))).alias("postal"),
            F.when((p["state"] == "") & g["state"].isNull(), first(o, lambda c: trusted(c) & (c["state"] != ""))).alias("state"),
        ),
    )
    x = F.col("__c_fill")
    given = F.array(*[g[f]["source"] for f in ("city", "state", "postal", "coords")])
    filled = F.array(x["postal"]["source"], x["state"]["source"])
    sources = F.concat(
        F.array(p["source"]),
        F.filter(F.transform(d, lambda c: c["source"]), lambda s: F.coalesce(F.array_contains(F.filter(given, lambda q: q.isNotNull()), s), F.lit(False))),
        F.transform(
            F.filter(F.transform(o, lambda c: c["source"]), lambda s: F.array_contains(F.filter(filled, lambda q: q.isNotNull()), s)),
            lambda s: F.concat(s, F.lit("?")),
        ),
    )
    some = n > 0
    pick = lambda *cs: F.coalesce(*cs, F.lit(""))
    lat = F.when(no_coords, F.coalesce(g["coords"]["lat"], p["lat"])).otherwise(p["lat"])
    lon = F.when(no_coords, F.coalesce(g["coords"]["lon"], p["lon"])).otherwise(p["lon"])
    df = df.withColumn(
        "__c_out",
        F.struct(
            F.when(some & (p["country"] != ""), p["country"]).otherwise(seed).alias("country"),
            pick(F.nullif(p["state"], F.lit("")), g["state"]["state"], x["state"]["state"]).alias("state"),
            pick(F.nullif(p["city"], F.lit("")), g["city"]["city"]).alias("city"),
            pick(F.nullif(p["postal"], F.lit("")), g["postal"]["postal"], x["postal"]["postal"]).alias("postal"),
            F.coalesce(lat, F.lit(0.0)).alias("lat"),
            F.coalesce(lon, F.lit(0.0)).alias("lon"),
            F.when(some, sources).otherwise(F.array().cast("array<string>")).alias("sources"),
            n.alias("n_valid"),
            F.when(some, F.size(members)).otherwise(0).alias("n_cluster"),
        ),
    )
    m = F.col("__c_out")
    score = confidence(m)
    fields = ("country", "state", "city", "postal", "lat", "lon", "sources", "n_valid", "n_cluster")
    return df.select(*[F.col(c) for c in kept], F.struct(*[m[f].alias(f) for f in fields], score.alias("confidence")).alias("merged"))


def confidence(m: Column) -> Column:
    """0 to 100 from the size of the agreeing group and the fields that are there; 0 without any."""
    base = F.when(m["n_cluster"] <= 1, 25).when(m["n_cluster"] == 2, 50).otherwise(65)
    everyone = F.when((m["n_cluster"] == m["n_valid"]) & (m["n_valid"] >= 2), 5).otherwise(0)
    there = lambda on, points: F.when(on, points).otherwise(0)
    score = (
        base
        + everyone
        + there(m["city"] != "", 10)
        + there(m["state"] != "", 5)
        + there(m["postal"] != "", 10)
        + there((m["lat"] != 0) | (m["lon"] != 0), 5)
    )
    return F.when(m["n_valid"] == 0, 0).otherwise(F.least(score, F.lit(100))).cast("int")
