"""Enrichment of merged blocks from postal and gazetteer tables.

Lookups are equi-joins against tables that hold one row for each key, so no window runs over the fact
side and no key multiplies rows. All lookups use the seed country.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text
from .joins import BROADCAST_ROWS, best_by_key, first_by_key

SNAP_KM = 100.0


def alternate_names(gazetteer: DataFrame) -> DataFrame:
    """One row for each name of an entry: name, ASCII name, alternate names, with their position."""
    names = F.concat(F.array("name", "asciiname"), F.split("alternatenames", ","))
    return gazetteer.select("*", F.posexplode(names).alias("pos", "any_name"))


def gazetteer_index(gazetteer: DataFrame) -> DataFrame:
    """(country, key, geoname_id): of each name the entry with most people, the earliest among equals.

    ``gazetteer``: line, geoname_id, name, asciiname, alternatenames, country, population."""
    named = alternate_names(gazetteer).withColumn("key", text.normalize_name(text.clean_city("any_name")))
    named = named.where("key <> ''")
    return best_by_key(named, ["country", "key"], "population", ["line", "pos"], ["geoname_id"])


def place_keys(place: str = "place") -> F.Column:
    """Keys of a place: its own name; of a name in parentheses all of it and its first word."""
    p = F.col(place)
    inside = text.trim(F.regexp_extract(p, r"(?s)\A[^(]*\(([^)]*)\)", 1))
    by_blank = F.regexp_extract(inside, r"(?s)\A([^ ]+) ", 1)
    by_hyphen = F.regexp_extract(inside, r"(?s)\A([^-]+)-", 1)
    first = F.when(by_blank != "", by_blank).when(by_hyphen != "", by_hyphen).otherwise(inside)
    aliases = F.filter(F.array(text.normalize_name(inside), text.normalize_name(first)), lambda k: k != "")
    return F.array_distinct(F.concat(F.array(text.normalize_name(p)), aliases))


def postal_by_city(postal: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(first of each (country, key), first of each (country, key, state_norm)) in file order.

    ``postal``: line, country, postal, place, state, lat, lon."""
    rows = postal.where("country <> ''").withColumn("key", F.explode(place_keys())).withColumn("state_norm", text.normalize_name("state"))
    payload = ["postal", "lat", "lon"]
    any_state = first_by_key(rows, ["country", "key"], ["line"], payload)
    by_state = first_by_key(rows, ["country", "key", "state_norm"], ["line"], payload)
    return any_state, by_state


def city_by_postal(postal: DataFrame) -> DataFrame:
    """(country, code, city, state, lat, lon): the first place of each code, as written and compact."""
    codes = F.array_distinct(F.array(F.col("postal"), text.normalize_postal("postal")))
    rows = postal.where("country <> ''").select("*", F.posexplode(codes).alias("kind", "code"))
    return first_by_key(
        rows.withColumnRenamed("place", "city"), ["country", "code"], ["line", "kind"], ["city", "state", "lat", "lon"]
    )


def city_keys(city: F.Column) -> F.Column:
    """The keys under which a city is looked up, in order: its name; transliterated if Cyrillic; if
    Latin the Cyrillic name of a known city."""
    n = text.normalize_name(text.clean_city(city))
    other = F.when(text.contains_cyrillic(n), text.transliterate(n)).otherwise(text.known_cyrillic(n))
    return F.array_distinct(F.filter(F.array(n, other), lambda k: k.isNotNull() & (k != "")))


def _side(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def lookup_city(blocks: DataFrame, any_state: DataFrame, by_state: DataFrame) -> DataFrame:
    """(country, city, state) -> hit_postal, hit_lat, hit_lon: the first key that has entries; of its
    entries the first of the same state, else the first. ``blocks`` holds distinct (country, city, state)."""
    keys = blocks.select("country", "city", "state", F.posexplode(city_keys(F.col("city"))).alias("pref", "key"))
    # without a state there is nothing to prefer; a state that normalises to '' meets entries without one
    keys = keys.withColumn("state_norm", F.when(F.col("state") != "", text.normalize_name("state")))
    a = any_state.select("country", "key", F.struct("postal", "lat", "lon").alias("any"))
    s = by_state.select("country", "key", "state_norm", F.struct("postal", "lat", "lon").alias("same"))
    hits = keys.join(_side(a), ["country", "key"]).join(_side(s), ["country", "key", "state_norm"], "left")
    best = F.min_by(F.coalesce("same", "any"), "pref").alias("hit")
    hits = hits.groupBy("country", "city", "state").agg(best)
    return hits.select(
        "country", "city", "state", F.col("hit.postal").alias("hit_postal"), F.col("hit.lat").alias("hit_lat"), F.col("hit.lon").alias("hit_lon")
    )


def enrich(blocks: DataFrame, postal: DataFrame) -> DataFrame:
    """Snap coordinates, fill the postal code from the city, then the city from the postal code.

    ``blocks`` has country (of the seed), m_state, m_city, m_postal, m_lat, m_lon; adds snapped,
    zip_filled, city_filled. One lookup serves the snap and the postal code, as both use the merged city
    and state."""
    any_state, by_state = postal_by_city(postal)
    wanted = blocks.where("m_city <> ''").select("country", F.col("m_city").alias("city"), F.col("m_state").alias("state")).distinct()
    hits = lookup_city(wanted, any_state, by_state)
    hits = hits.select("country", F.col("city").alias("m_city"), F.col("state").alias("m_state"), "hit_postal", "hit_lat", "hit_lon")
    out = blocks.join(hits, ["country", "m_city", "m_state"], "left")
    has = (F.col("m_lat") != 0) | (F.col("m_lon") != 0)
    km = geo.haversine_asin_km(F.col("m_lat"), F.col("m_lon"), F.col("hit_lat"), F.col("hit_lon"))
    snap = F.col("hit_lat").isNotNull() & (~has | ~geo.less(F.lit(SNAP_KM), km))
    out = out.withColumn("snapped", F.coalesce(snap, F.lit(False)))
    out = out.withColumn("zip_filled", (F.col("m_postal") == "") & (F.col("m_city") != "") & F.coalesce(F.col("hit_postal") != "", F.lit(False)))
    out = out.withColumns(
        {
            "m_lat": F.when(F.col("snapped"), F.col("hit_lat")).otherwise(F.col("m_lat")),
            "m_lon": F.when(F.col("snapped"), F.col("hit_lon")).otherwise(F.col("m_lon")),
            "m_postal": F.when(F.col("zip_filled"), F.col("hit_postal")).otherwise(F.col("m_postal")),
        }
    ).drop("hit_postal", "hit_lat", "hit_lon")

    back = city_by_postal(postal).select("country", "code", F.struct("city", "state", "lat", "lon").alias("p"))
    codes = out.where("m_city = '' and m_postal <> ''").select("country", "m_postal").distinct()
    codes = codes.select("country", "m_postal", F.posexplode(F.array_distinct(F.array(F.col("m_postal"), text.normalize_postal("m_postal")))).alias("pref", "code"))
    found = codes.join(_side(back), ["country", "code"]).groupBy("country", "m_postal").agg(F.min_by("p", "pref").alias("p"))
    out = out.join(found, ["country", "m_postal"], "left")
    fill = (F.col("m_city") == "") & F.col("p").isNotNull()
    has = (F.col("m_lat") != 0) | (F.col("m_lon") != 0)
    out = out.withColumn("city_filled", F.coalesce(fill, F.lit(False)))
    coords = F.col("city_filled") & ~has
    return out.withColumns(
        {
            "m_city": F.when(F.col("city_filled"), F.col("p.city")).otherwise(F.col("m_city")),
            "m_state": F.when(F.col("city_filled") & (F.col("m_state") == ""), F.col("p.state")).otherwise(F.col("m_state")),
            "m_lat": F.when(coords, F.col("p.lat")).otherwise(F.col("m_lat")),
            "m_lon": F.when(coords, F.col("p.lon")).otherwise(F.col("m_lon")),
            "snapped": F.col("snapped") | F.coalesce(coords, F.lit(False)),
        }
    ).drop("p")


def accuracy_radius(snapped, confidence, bits) -> F.Column:
    return (
        F.when(snapped, 20)
        .when((confidence >= 85) & (bits >= 24), 25)
        .when(confidence >= 75, 50)
        .when(confidence >= 50, 100)
        .otherwise(250)
    )


def time_zone(df: DataFrame, zones: DataFrame | None, lat: str = "lat", lon: str = "lon", cell: float = 0.25) -> DataFrame:
    """``df`` with time_zone from the caller's data, 'UTC' where it has none: polygons (time_zone, ring: array of
    struct<x, y>, longitude and latitude), or a grid table (cell_y, cell_x, time_zone) of ``cell`` degrees."""
    if zones is None:
        return df.withColumn("time_zone", F.lit("UTC"))
    if "ring" in zones.columns:
        found = zones_of(df.select(F.col(lat).alias("y"), F.col(lon).alias("x")), zones)
        out = df.join(found, (F.col(lat) == F.col("y")) & (F.col(lon) == F.col("x")), "left").drop("y", "x")
    else:
        at = df.withColumn("cell_y", F.floor(F.col(lat) / cell)).withColumn("cell_x", F.floor(F.col(lon) / cell))
        out = at.join(_side(zones), ["cell_y", "cell_x"], "left").drop("cell_y", "cell_x")
    return out.withColumn("time_zone", F.coalesce("time_zone", F.lit("UTC")))


def zones_of(places: DataFrame, polygons: DataFrame, cell: float = 1.0) -> DataFrame:
    """(y, x, time_zone) of the distinct places that lie in a polygon, the first zone by name in several.

    A polygon is listed in each cell of the box around it, and a place is tested against those of its own cell: it is
    inside if a ray to the east crosses the ring an odd number of times."""
    at = lambda f, c: F.floor(f(F.transform("ring", lambda p: p[c])) / cell)
    listed = polygons.select(
        "time_zone", "ring", F.explode(F.sequence(at(F.array_min, "y"), at(F.array_max, "y"))).alias("cy"), at(F.array_min, "x").alias("x0"), at(F.array_max, "x").alias("x1")
    )
    listed = listed.select("time_zone", "ring", "cy", F.explode(F.sequence("x0", "x1")).alias("cx"))
    y, x = F.col("y"), F.col("x")
    spots = places.where("y is not null and x is not null").distinct().withColumn("cy", F.floor(y / cell)).withColumn("cx", F.floor(x / cell))
    # each vertex with the next one, the last with the first
    edges = F.arrays_zip(F.col("ring").alias("a"), F.concat(F.slice("ring", 2, F.size("ring")), F.slice("ring", 1, 1)).alias("b"))
    a, b = (lambda e: e["a"]), (lambda e: e["b"])
    level = lambda e: (a(e)["y"] > y) != (b(e)["y"] > y)
    before = lambda e: x < (b(e)["x"] - a(e)["x"]) * (y - a(e)["y"]) / (b(e)["y"] - a(e)["y"]) + a(e)["x"]
    crossed = F.size(F.filter(F.filter(edges, level), before))
    hits = spots.join(listed, ["cy", "cx"]).where(crossed % 2 == 1)
    return hits.groupBy("y", "x").agg(F.min("time_zone").alias("time_zone"))
