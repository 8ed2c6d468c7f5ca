"""The compiled release: seed ranges -> blocks -> opinions -> consensus -> enrichment -> columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, geo, ip, text
from ..operators import consensus, enrich, joins
from ..operators.boundary import settled

# ---- fixed values: columns of the release, in order ------------------------------------------------
COLUMNS = (
    "start_ip", "end_ip", "matched_prefix", "continent_code", "continent_name", "country_code", "country_name",
    "registry_country_code", "subdivision_name", "city_geoname_id", "city_name", "postal_code", "latitude",
    "longitude", "time_zone", "accuracy_radius_km", "confidence", "source_updated_at",
)
# ---- fixed values: members of the European Union ---------------------------------------------------
EU = (
    "AT", "BE", "BG", "CY", "CZ", "DE", "DK", "EE", "ES", "FI", "FR", "GR", "HR", "HU", "IE", "IT", "LT", "LU",
    "LV", "MT", "NL", "PL", "PT", "RO", "SE", "SI", "SK",
)
# ---- fixed values: continents ------------------------------------------------------------------------
CONTINENTS = {
    "AF": "Africa", "AN": "Antarctica", "AS": "Asia", "EU": "Europe", "NA": "North America", "OC": "Oceania", "SA": "South America",
}

COUNTRY = "country_code string, country_name string, continent_code string, calling_code string, currency_code string"


@dataclass
class Inputs:
    """Tables of a build; only the seed is mandatory. Donors: ip_start, ip_end and what ``opinions`` reads.

    countries: COUNTRY rows (see ``countries``); zones: see ``enrich.time_zone``."""

    seed: DataFrame
    geofeed: DataFrame | None = None
    maxmind: DataFrame | None = None
    ip2loc: DataFrame | None = None
    sypex: DataFrame | None = None
    registry: DataFrame | None = None
    postal: DataFrame | None = None
    gazetteer: DataFrame | None = None
    countries: DataFrame | None = None
    zones: DataFrame | None = None


def countries(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The country table: a CSV with COUNTRY columns, or what the Java runtime's locale data say (names
    and currencies; continents and calling codes are then '')."""
    if path:
        return spark.read.schema(COUNTRY).option("header", "true").csv(path).na.fill("")
    jvm, rows = spark._jvm, []
    for code in jvm.java.util.Locale.getISOCountries():
        place = jvm.java.util.Locale("", code)
        money = jvm.java.util.Currency.getInstance(place)
        rows.append((code, place.getDisplayCountry(jvm.java.util.Locale.ENGLISH), "", "", money.getCurrencyCode() if money else ""))
    return spark.createDataFrame(rows, COUNTRY)


def blocks(seed: DataFrame, split_cis: bool = False) -> DataFrame:
    """One row for each block of a seed range: the seed's columns, addr, bits. ``split_cis``: blocks of CIS
    countries that are shorter than /24 are split into /24."""
    out = seed.withColumn("b", F.explode(ip.cover("ip_start", "ip_end")))
    if split_cis:
        cis = F.col("country").isin(*fixed.CIS)
        out = out.withColumn("b", F.explode(F.when(cis, ip.split24("b")).otherwise(F.array("b"))))
    return out.select("*", F.col("b.addr").alias("addr"), F.col("b.bits").alias("bits")).drop("b", "ip_start", "ip_end")


def resolve(rows: DataFrame, inputs: Inputs) -> DataFrame:
    """What the donors and the registry say of each distinct address of ``rows``, in one written table: addr, and a
    struct for each of gf, mm, i2, sx (null without a record), and cc."""
    at = settled(rows.select("addr").where("addr is not null").distinct())
    found = at
    if inputs.geofeed is not None:
        payload = ["country", "state", "city", "postal"]
        hits = joins.longest_prefix(at, inputs.geofeed, payload, ["file", "line"])
        found = found.join(joins.shuffled(hits.select("addr", F.struct(*payload).alias("gf"))), "addr", "left")
    points = {
        "mm": (inputs.maxmind, ["city", "country", "subdivisions", "postal", "location"]),
        "i2": (inputs.ip2loc, ["country_short", "region", "city", "zipcode", "latitude", "longitude"]),
        "sx": (inputs.sypex, ["country_iso", "city_en", "city_ru", "region_en", "latitude", "longitude"]),
    }
    for name, (donor, payload) in points.items():
        if donor is not None:
            hits = joins.point_in_range(at, donor, payload)
            found = found.join(joins.shuffled(hits.select("addr", F.struct(*payload).alias(name))), "addr", "left")
    if inputs.registry is not None:
        hits = joins.as_of_range(at, inputs.registry, ["cc"], ["file", "line"])
        found = found.join(joins.shuffled(hits), "addr", "left")
    return settled(found)


def gather(rows: DataFrame, inputs: Inputs) -> DataFrame:
    """``rows`` (blocks) with the array of opinions: seed, geofeed, maxmind, ip2loc, sypex, in this order, and cc
    where there is a registry. All donors are looked up once for each address; the blocks meet the result in
    one join."""
    none, no = F.lit(""), F.lit(0.0)
    country = F.col("country")
    rows = rows.join(joins.shuffled(resolve(rows, inputs)), "addr", "left")
    slots = [consensus.candidate("dbip", country, F.col("state"), F.col("city"), none, none, F.col("lat"), F.col("lon"), F.col("has_coords"))]
    if inputs.geofeed is not None:
        c = F.col("gf")
        slots.append(F.when(c.isNotNull(), consensus.candidate("geofeed", c["country"], c["state"], c["city"], none, c["postal"], no, no, F.lit(False))))
    if inputs.maxmind is not None:
        c = F.col("mm")
        own = F.coalesce(F.nullif(c["country"]["iso_code"], none), country)
        lat, lon = F.coalesce(c["location"]["latitude"], no), F.coalesce(c["location"]["longitude"], no)
        state = F.try_element_at(F.get(c["subdivisions"], F.lit(0))["names"], F.lit("en"))
        city = F.try_element_at(c["city"]["names"], F.lit("en"))
        # an address without a record is an opinion without content, which is dropped later
        slots.append(consensus.candidate("maxmind", own, state, city, none, c["postal"]["code"], lat, lon, (lat != 0) | (lon != 0)))
    if inputs.ip2loc is not None:
        c = F.col("i2")
        own = F.upper(text.trim(F.coalesce(c["country_short"], none)))
        own = F.when(own.isin("", "-"), country).otherwise(own)
        lat, lon = (F.coalesce(c[k].cast("double"), no) for k in ("latitude", "longitude"))
        slots.append(consensus.candidate("ip2loc", own, c["region"], c["city"], none, c["zipcode"], lat, lon, (lat != 0) | (lon != 0)))
    if inputs.sypex is not None:
        c = F.col("sx")
        own = F.coalesce(F.nullif(F.upper(c["country_iso"]), none), country)
        lat, lon = F.coalesce(c["latitude"], no), F.coalesce(c["longitude"], no)
        has = (lat != 0) | (lon != 0)
        some = (F.coalesce(c["city_en"], none) != "") | (F.coalesce(c["city_ru"], none) != "") | has
        slots.append(
            F.when(country.isin(*fixed.CIS) & some, consensus.candidate("sypex", own, c["region_en"], c["city_en"], c["city_ru"], none, lat, lon, has))
        )
    rows = rows.withColumn("candidates", F.filter(F.array(*slots), lambda c: c.isNotNull()))
    return rows.drop("gf", "mm", "i2", "sx")


def build(inputs: Inputs, built_at: str = "", cfg: consensus.Config = consensus.DEFAULT) -> DataFrame:
    """One row for each block: COLUMNS as the release file has them, before formatting, and sources."""
    rows = gather(settled(blocks(inputs.seed, split_cis=inputs.sypex is not None)), inputs)
    rows = rows.withColumn("registry", F.coalesce("cc", "country") if inputs.registry is not None else F.col("country"))
    rows = consensus.merge(rows, cfg=cfg)
    m = F.col("merged")
    rows = rows.select(
        "addr", "bits", "country", "registry", m["country"].alias("m_country"), m["state"].alias("m_state"), m["city"].alias("m_city"),
        m["postal"].alias("m_postal"), m["lat"].alias("m_lat"), m["lon"].alias("m_lon"), m["confidence"].alias("confidence"), m["sources"].alias("sources"),
    )
    rows = settled(rows).where(F.col("confidence") >= cfg.min_confidence)
    if inputs.postal is not None:
        rows = enrich.enrich(rows, inputs.postal)
        marks = [F.when(F.col(c), F.lit(s)) for c, s in (("zip_filled", "geonames"), ("city_filled", "geonames-rev"))]
        rows = rows.withColumn("sources", F.concat("sources", F.filter(F.array(*marks), lambda s: s.isNotNull())))
        rows = settled(rows)
    else:
        rows = rows.withColumns({c: F.lit(False) for c in ("snapped", "zip_filled", "city_filled")})
    state, city = text.dedupe_state_city("m_state", "m_city")
    rows = rows.withColumn("lat", geo.round_coord(F.col("m_lat"))).withColumn("lon", geo.round_coord(F.col("m_lon")))
    rows = rows.withColumn("subdivision_name", state).withColumn("city_name", city)
    if inputs.gazetteer is not None:
        index = enrich.gazetteer_index(inputs.gazetteer).select(F.col("country").alias("m_country"), F.col("key").alias("g_key"), "geoname_id")
        rows = rows.withColumn("g_key", text.normalize_name(text.clean_city("m_city")))
        rows = rows.join(enrich._side(index), ["m_country", "g_key"], "left").drop("g_key")
    else:
        rows = rows.withColumn("geoname_id", F.lit(None).cast("long"))
    rows = enrich.time_zone(rows, inputs.zones)
    if inputs.countries is not None:
        dims = inputs.countries.withColumnRenamed("country_code", "m_country")
        rows = rows.join(enrich._side(dims), "m_country", "left")
    else:
        rows = rows.withColumns({c: F.lit("") for c in ("country_name", "continent_code", "calling_code", "currency_code")})
    names = F.create_map(*[F.lit(x) for kv in CONTINENTS.items() for x in kv])
    blank = F.lit("")
    return rows.select(
        ip.to_text(F.col("addr")).alias("start_ip"),
        ip.to_text(ip.last(F.col("addr"), F.col("bits"))).alias("end_ip"),
        ip.cidr(F.col("addr"), F.col("bits")).alias("matched_prefix"),
        F.coalesce("continent_code", blank).alias("continent_code"),
        F.coalesce(F.try_element_at(names, F.col("continent_code")), F.lit("Unknown")).alias("continent_name"),
        F.col("m_country").alias("country_code"),
        F.coalesce(F.nullif(F.col("country_name"), blank), "m_country").alias("country_name"),
        F.coalesce(F.nullif(F.col("registry"), blank), "m_country").alias("registry_country_code"),
        "subdivision_name",
        F.coalesce("geoname_id", F.lit(0)).alias("city_geoname_id"),
        "city_name",
        F.col("m_postal").alias("postal_code"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        "time_zone",
        enrich.accuracy_radius(F.col("snapped"), F.col("confidence"), F.col("bits")).alias("accuracy_radius_km"),
        "confidence",
        F.lit(built_at).alias("source_updated_at"),
        "sources",
        F.coalesce("calling_code", blank).alias("calling_code"),
        F.coalesce("currency_code", blank).alias("currency_code"),
        F.col("m_country").isin(*EU).alias("is_eu_member"),
        "snapped",
        "zip_filled",
        "city_filled",
    )


def as_csv(release: DataFrame) -> DataFrame:
    """The 18 text columns of the release file."""
    fixed5 = lambda c: F.format_string("%.5f", F.col(c))
    number = F.when(F.col("city_geoname_id") == 0, "").otherwise(F.col("city_geoname_id").cast("string"))
    put = {"latitude": fixed5("latitude"), "longitude": fixed5("longitude"), "city_geoname_id": number}
    return release.select(*[put.get(c, F.col(c).cast("string")).alias(c) for c in COLUMNS])


def nested(release: DataFrame) -> DataFrame:
    """The record of a block as the lookup database holds it."""
    meta = F.create_map("country_code", F.struct("country_name", "calling_code", "currency_code", "is_eu_member"))
    names = (
        "latitude longitude time_zone accuracy_radius_km continent_name continent_code country_name country_code "
        "registry_country_code subdivision_name city_name postal_code"
    ).split()
    number = F.when(F.col("city_geoname_id") != 0, F.col("city_geoname_id")).alias("city_geoname_id")
    return release.select(
        "matched_prefix", "confidence", "source_updated_at", meta.alias("country_metadata"), F.struct(*names, number).alias("location")
    )


def counters(release: DataFrame) -> DataFrame:
    """Run counters of a build: confidence buckets and enrichment counts."""
    c = F.col("confidence")
    return release.agg(
        F.count_if(c >= 75).alias("high"),
        F.count_if((c >= 50) & (c < 75)).alias("moderate"),
        F.count_if(c < 50).alias("low"),
        F.count_if("snapped").alias("snapped"),
        F.count_if("zip_filled").alias("zip_filled"),
        F.count_if("city_filled").alias("city_filled"),
    )


def write_csv(release: DataFrame, path: str) -> None:
    as_csv(release).write.mode("overwrite").options(header="true", quote='"', escape='"', emptyValue="").csv(path)


def write_parquet(release: DataFrame, path: str) -> None:
    """The nested records, clustered by address, so that lookups by range read few files."""
    start = ip.to_int(F.substring_index("matched_prefix", "/", 1))
    rows = nested(release).withColumn("ip_start", start)
    rows.repartitionByRange("ip_start").sortWithinPartitions("ip_start").write.mode("overwrite").parquet(path)
