"""Deterministic stand-ins for geographic inputs, derived from the generic tables, as DataFrames and as
the same SQL. The generic tables have no addresses, places or coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CODES = ("RU", "US", "DE", "FR", "GB", "BR", "CN", "JP", "UA", "KZ", "IN", "IT")
NAMES = (
    "Moscow", "Saint-Petersburg", "St. Petersburg", "New York", "New York City", "München", "Kyoto-shi", "Seoul City",
    "Ciudad de Mexico", "City of London", "Kazan'", "Sao Paulo", "Thanh pho Hue", "Berlin (Mitte)", "n/a", "",
    "Nizhny Novgorod", "Frankfurt am Main", "-", "Unknown",
)
STATES = (
    "Moscow Oblast", "Horad Minsk", "Minskaya voblasts'", "Almaty Qalasy", "Doha Governorate", "Provincia de Cordoba",
    "Estado de Sao Paulo", "Moskovskaya oblast'", "Northern District", "Seoul-teukbyeolsi", "", "New York", "Bayern", "n/a",
)
CYRILLIC = ("москва", "санкт петербург", "казань", "щёлково", "жуковский", "объезд", "київ", "ЮЖНЫЙ", "moscow", "ёлка ъ")
BROKEN = (
    "SÃ£o Paulo", "BogotÃ¡", "MÃ¼nchen", "Sanaâ€™a", "Plain", "Ã la carte", "Kazan’", "Ñandú", "city �", "x oblast'",
    "Ð city", "Â", "ok â€œquoted", "dÃ©jÃ vu",
)
KNOWN = ("москва", "казань", "нет такого", "moscow", "", "санкт петербург")
FLOATS = ("1.5", "-2", "+3.25", "1e3", " 7", "7 ", "1f", "1.5d", "x", "", ".5", "5.", "1,5", "0x1p3z")
POSTALS = ("SW1A 1AA", " 10-115 ", "0000", "0 -", "101000", "101 999", "ab-12", "N/A", "", "80331")


def quoted(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(values, index: str) -> F.Column:
    """The value at an index expression (taken modulo the number of values)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.expr(f"({index}) % {len(values)}") + 1).cast("int"))


def pick_sql(values, index: str) -> str:
    return f"({quoted(values)})[cast(({index}) % {len(values)} + 1 as int)]"


def hundredths(n: str, less: int) -> F.Column:
    """(n) / 100.0 - less as the SQL has it: its / gives doubles, where Spark's decimals would round once only and end
    one unit in the last place away, at times on the other side of a limit."""
    return F.expr(f"cast({n} as double) / 100D - {less}D")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# an address for each order, spread over the whole space
ADDR = "(o_orderkey * 2654435761) % 4294967296"


def addresses(spark, d) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.expr(ADDR).alias("addr"))


ADDRESSES_SQL = f"(select o_orderkey, {ADDR} as addr from orders)"

# seed ranges, disjoint, of irregular length
RANGE_START = "s_suppkey * 4000037 + s_suppkey % 7"
RANGE_END = "s_suppkey * 4000037 + s_suppkey % 7 + (s_suppkey * 7919) % 3900000"


def ranges(spark, d) -> DataFrame:
    return table(spark, d, "supplier").select(
        "s_suppkey", F.expr(RANGE_START).alias("ip_start"), F.expr(RANGE_END).alias("ip_end"),
        pick(CODES, "s_suppkey").alias("country"), pick(STATES, "s_suppkey").alias("state"), pick(NAMES, "s_suppkey").alias("city"),
        hundredths("s_suppkey * 37 % 18000", 90).alias("lat"), hundredths("s_suppkey * 91 % 36000", 180).alias("lon"),
    )


RANGES_SQL = f"""(select s_suppkey, {RANGE_START} as ip_start, {RANGE_END} as ip_end, {pick_sql(CODES, "s_suppkey")} as country,
  {pick_sql(STATES, "s_suppkey")} as state, {pick_sql(NAMES, "s_suppkey")} as city,
  cast((s_suppkey * 37 % 18000) / 100.0 - 90 as double) as lat, cast((s_suppkey * 91 % 36000) / 100.0 - 180 as double) as lon
  from supplier)"""

# a feed of nested blocks with host bits, from the parts
FEED_BITS = "6 + p_partkey % 13"
FEED_START = "(p_partkey * 123456789) % 4294967296"


def feed(spark, d) -> DataFrame:
    size = F.expr(f"cast(power(2, 32 - ({FEED_BITS})) as bigint)")
    df = table(spark, d, "part").select("p_partkey", F.expr(FEED_BITS).cast("int").alias("bits"), F.expr(FEED_START).alias("ip_start"), size.alias("n"))
    end = F.expr("ip_start - ip_start % n + n - 1")
    return df.select("p_partkey", "bits", "ip_start", end.alias("ip_end"), F.lit("f").alias("file"), F.col("p_partkey").alias("line"))


FEED_SQL = f"""(select p_partkey, bits, ip_start, ip_start - ip_start % n + n - 1 as ip_end
  from (select p_partkey, cast({FEED_BITS} as int) as bits, {FEED_START} as ip_start,
               cast(power(2, 32 - ({FEED_BITS})) as bigint) as n from part))"""

# ---- lines of the input files: what they hold as columns (the same expressions in both dialects), and as text

#: an address of four octets and its number
OCTETS = "cast(k % 220 + 1 as string) || '.' || cast(k % 251 as string) || '.' || cast(k * 7 % 256 as string) || '.' || cast(k % 5 * 16 as string)"
NUMBER = "(((k % 220 + 1) * 256 + k % 251) * 256 + k * 7 % 256) * 256 + k % 5 * 16"

FEED_FIELDS = {
    "k": "k", "addr": NUMBER, "ip": OCTETS, "n_bits": "8 + k % 20",
    "country": "case k % 4 when 0 then 'us' when 1 then ' de ' when 2 then 'FR ' else '' end",
    "state": "case when k % 3 = 0 then '' else ' US-' || cast(k % 50 as string) end",
    "city": "case k % 6 when 0 then 'Say \"Hi\", City' when 1 then ' Spaced  ' when 2 then 'a\"b' else 'Town ' || cast(k as string) end",
    "postal": "cast(10000 + k % 900 as string)",
    "kind": "case when k % 17 = 0 then 'comment' when k % 19 = 0 then 'short' when k % 23 = 0 then 'bad' else 'row' end",
}
SEED_FIELDS = {
    "k": "k", "a": NUMBER, "start_ip": "case when k % 13 = 0 then '2001:db8::1' when k % 17 = 0 then '1.2.3' else " + OCTETS + " end",
    "end_ip": "case when k % 13 = 0 then '2001:db8::ff' else ' ' || " + OCTETS + " || ' ' end", "continent": "'EU'",
    "country": "case when k % 7 = 0 then null else 'DE' end", "state": "'S' || cast(k % 9 as string)", "city": "'C' || cast(k % 99 as string)",
    "latitude": "case k % 5 when 0 then '0' when 1 then 'x' when 2 then ' 5.5' when 3 then '51.25' else '-7.5e0' end",
    "longitude": "case k % 4 when 0 then '0' when 1 then '' when 2 then '9.5f' else '+13.75' end",
    "lat": "case k % 5 when 3 then 51.25 when 4 then -7.5 else 0 end", "lon": "case k % 4 when 3 then 13.75 else 0 end",
    "kind": "case when k % 13 = 0 or k % 17 = 0 then 'other' else 'row' end",
}
REGISTRY_FIELDS = {
    "k": "k", "addr": NUMBER, "ip": OCTETS,
    "cc": "case k % 6 when 0 then 'us' when 1 then ' DE ' when 2 then 'ZZ' when 3 then '' else 'FR' end",
    "family": "case when k % 7 = 0 then 'ipv6' when k % 11 = 0 then 'asn' else 'ipv4' end",
    "size": "case when k % 9 = 0 then 0 else k % 5 * 256 + 256 end", "fields": "case when k % 10 = 0 then 6 else 7 end",
}
PLACE_FIELDS = {
    "k": "k", "country": "case k % 3 when 0 then 'us' when 1 then ' De' else 'FR' end", "postal": "case when k % 11 = 0 then '' else ' ' || cast(k % 900 as string) end",
    "place": "case when k % 13 = 0 then ' ' else 'Place ' || cast(k % 70 as string) || ' ' end", "state": "'St ' || cast(k % 5 as string)",
    "lat": "case k % 3 when 0 then '1.5' when 1 then 'north' else '-2.25' end", "lon": "case k % 2 when 0 then '7' else '' end",
    "fields": "case when k % 17 = 0 then 11 else 12 end",
}
TOWN_FIELDS = {
    "k": "k", "number": "case when k % 12 = 0 then 'x' || cast(k as string) when k % 18 = 1 then '0' else cast(k as string) end",
    "name": "'Town ' || cast(k % 90 as string)", "class": "case k % 4 when 0 then 'A' else 'P' end",
    "country": "case k % 5 when 0 then '' when 1 then ' us' else 'DE' end", "population": "case k % 7 when 0 then 'many' else cast(k * 31 % 5000 as string) end",
    "fields": "case when k % 19 = 0 then 14 else 15 end",
}


def fields(spark: SparkSession, d, columns: dict, source: str, key: str) -> DataFrame:
    return table(spark, d, source).selectExpr(f"{key} as k").selectExpr(*[f"{e} as {c}" for c, e in columns.items()])


def fields_sql(columns: dict, source: str, key: str) -> str:
    return "(select " + ", ".join(f"{e} as {c}" for c, e in columns.items()) + f" from (select {key} as k from {source}))"


def lines(spark: SparkSession, d, columns: dict, source: str, key: str, value) -> DataFrame:
    """(file, line, value): the columns as lines of a file."""
    return fields(spark, d, columns, source, key).select(F.lit("f").alias("file"), F.col("k").alias("line"), value.alias("value"))


def quoted_field(c: str) -> F.Column:
    return F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))


def separated(columns: dict[int, str], n: str) -> F.Column:
    """A line of ``n`` (a column) fields with tabs between, of which some are given by their place."""
    every = F.array(*[F.col(columns[k]) if k in columns else F.lit(f"f{k}") for k in range(max(columns) + 5)])
    return F.array_join(F.slice(every, F.lit(1), F.col(n)), "\t")


# registry ranges that overlap
REG_START = "(c_custkey * 2862933) % 4294967296"


def registry(spark, d) -> DataFrame:
    return table(spark, d, "customer").select(
        F.expr(REG_START).alias("ip_start"), F.expr(f"{REG_START} + (c_custkey * 65537) % 6000000").alias("ip_end"),
        pick(CODES, "c_custkey").alias("cc"), F.lit("f").alias("file"), F.col("c_custkey").alias("line"),
    )


REGISTRY_SQL = f"""(select {REG_START} as ip_start, {REG_START} + (c_custkey * 65537) % 6000000 as ip_end,
  {pick_sql(CODES, "c_custkey")} as cc, c_custkey as line from customer)"""

# points: coordinates of customers
LAT, LON = "cast((c_custkey * 377 % 19000) / 100.0 - 95 as double)", "cast((c_custkey * 913 % 37000) / 100.0 - 185 as double)"


def points(spark, d) -> DataFrame:
    near = F.expr("c_custkey % 5 = 0")
    lat = F.when(near, F.lit(51.0) + F.expr("cast(c_custkey % 9 as double) / 100")).otherwise(hundredths("c_custkey * 377 % 19000", 95))
    lon = F.when(near, F.lit(9.0) + F.expr("cast(c_custkey % 8 as double) / 100")).otherwise(hundredths("c_custkey * 913 % 37000", 185))
    return table(spark, d, "customer").select("c_custkey", pick(CODES, "c_custkey").alias("country"), lat.alias("lat"), lon.alias("lon"))


POINTS_SQL = f"""(select c_custkey, {pick_sql(CODES, "c_custkey")} as country,
  case when c_custkey % 5 = 0 then 51.0::double + cast(c_custkey % 9 as double) / 100 else {LAT} end as lat,
  case when c_custkey % 5 = 0 then 9.0::double + cast(c_custkey % 8 as double) / 100 else {LON} end as lon from customer)"""


def words(spark, d, values, alias: str = "v", tail: bool = True) -> DataFrame:
    """(c_custkey, v): the values over the customers, some with the customer's name behind."""
    v = pick(values, "c_custkey")
    if tail:
        v = F.when(F.expr("c_custkey % 3 = 0"), F.concat(v, F.lit(" "), F.col("c_mktsegment"))).otherwise(v)
    return table(spark, d, "customer").select("c_custkey", v.alias(alias))


def words_sql(values, alias: str = "v", tail: bool = True) -> str:
    v = pick_sql(values, "c_custkey")
    if tail:
        v = f"case when c_custkey % 3 = 0 then {v} || ' ' || c_mktsegment else {v} end"
    return f"(select c_custkey, {v} as {alias} from customer)"


def postal(spark, d) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("line"), pick(CODES, "p_partkey").alias("country"),
        F.concat(F.expr("cast(10000 + p_partkey * 7 % 900 as string)"), F.expr("case when p_partkey % 4 = 0 then ' A' else '' end")).alias("postal"),
        F.concat(F.lit("Place "), F.expr("cast(p_partkey % 60 as string)")).alias("place"),
        F.concat(F.lit("State "), F.expr("cast(p_partkey % 3 as string)")).alias("state"),
        F.expr("cast(p_partkey % 120 as double) - 60").alias("lat"), F.expr("cast(p_partkey % 300 as double) - 150").alias("lon"),
    )


POSTAL_SQL = f"""(select p_partkey as line, {pick_sql(CODES, "p_partkey")} as country,
  cast(10000 + p_partkey * 7 % 900 as varchar) || case when p_partkey % 4 = 0 then ' A' else '' end as postal,
  'Place ' || cast(p_partkey % 60 as varchar) as place, 'State ' || cast(p_partkey % 3 as varchar) as state,
  cast(p_partkey % 120 as double) - 60 as lat, cast(p_partkey % 300 as double) - 150 as lon from part)"""


def gazetteer(spark, d) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("line"), F.col("p_partkey").alias("geoname_id"), pick(CODES, "p_partkey").alias("country"),
        F.concat(F.lit("Place "), F.expr("cast(p_partkey % 60 as string)")).alias("name"),
        F.concat(F.lit("place-"), F.expr("cast(p_partkey % 50 as string)")).alias("asciiname"),
        F.concat(F.lit("Town "), F.expr("cast(p_partkey % 40 as string)"), F.lit(",Burg "), F.expr("cast(p_partkey % 30 as string)")).alias("alternatenames"),
        F.expr("p_partkey * 7 % 500").alias("population"),
    )


GAZETTEER_SQL = f"""(select p_partkey as line, p_partkey as geoname_id, {pick_sql(CODES, "p_partkey")} as country,
  ['Place ' || cast(p_partkey % 60 as varchar), 'place-' || cast(p_partkey % 50 as varchar),
   'Town ' || cast(p_partkey % 40 as varchar), 'Burg ' || cast(p_partkey % 30 as varchar)] as names,
  p_partkey * 7 % 500 as population from part)"""


def release(spark, d, part: str) -> DataFrame:
    """Two releases over the orders: 'previous' and 'current'."""
    gone, shift = ("o_orderkey % 11 = 0", 0) if part == "current" else ("o_orderkey % 13 = 0", 1)
    df = table(spark, d, "orders").where(f"not ({gone})")
    blank = lambda c, k, n: F.when(F.expr(f"(o_orderkey + {shift * k}) % {n} = 0"), "").otherwise(c)
    return df.select(
        F.concat(F.lit("10."), F.expr("cast(o_orderkey div 65536 % 256 as string)"), F.lit("."), F.expr("cast(o_orderkey div 256 % 256 as string)"),
                 F.lit("."), F.expr("cast(o_orderkey % 256 as string)"), F.lit("/32")).alias("matched_prefix"),
        blank(pick(CODES, "o_custkey"), 1, 400).alias("country_code"), pick(CODES, "o_custkey").alias("country_name"),
        pick(CODES, f"o_custkey + (o_orderkey + {shift}) % 2").alias("registry_country_code"), F.lit("").alias("subdivision_name"),
        blank(pick(NAMES, f"o_custkey + {shift} * (o_orderkey % 2)"), 2, 50).alias("city_name"),
        blank(F.expr("cast(o_orderkey % 900 as string)"), 3, 30).alias("postal_code"),
        blank(F.expr("cast(o_custkey as string)"), 4, 20).alias("city_geoname_id"),
        F.expr(f"cast((o_orderkey * 7 + {shift} * (o_custkey % 30)) % 101 as int)").alias("confidence"),
    )


def release_sql(part: str) -> str:
    gone, shift = ("o_orderkey % 11 = 0", 0) if part == "current" else ("o_orderkey % 13 = 0", 1)
    blank = lambda c, k, n: f"case when (o_orderkey + {shift * k}) % {n} = 0 then '' else {c} end"
    return f"""(select '10.' || cast(o_orderkey // 65536 % 256 as varchar) || '.' || cast(o_orderkey // 256 % 256 as varchar) || '.'
      || cast(o_orderkey % 256 as varchar) || '/32' as matched_prefix,
    {blank(pick_sql(CODES, "o_custkey"), 1, 400)} as country_code, {pick_sql(CODES, "o_custkey")} as country_name,
    {pick_sql(CODES, f"o_custkey + (o_orderkey + {shift}) % 2")} as registry_country_code, '' as subdivision_name,
    {blank(pick_sql(NAMES, f"o_custkey + {shift} * (o_orderkey % 2)"), 2, 50)} as city_name,
    {blank("cast(o_orderkey % 900 as varchar)", 3, 30)} as postal_code,
    {blank("cast(o_custkey as varchar)", 4, 20)} as city_geoname_id,
    cast((o_orderkey * 7 + {shift} * (o_custkey % 30)) % 101 as int) as confidence
    from orders where not ({gone}))"""


# ---- inputs of a whole build ------------------------------------------------------------------------
# The same expressions in both dialects: {s} is a supplier's key, with the ranges' columns at hand.

B_CITY = "case s_suppkey % 3 when 0 then 'Place ' || cast(s_suppkey % 80 as string) when 1 then city else '' end"
B_STATE = "case s_suppkey % 4 when 0 then 'State ' || cast(s_suppkey % 3 as string) else state end"
I_CITY = "case when s_suppkey % 2 = 0 then city else '' end"
I_ZIP = "case when s_suppkey % 5 = 0 then '' else cast(10000 + s_suppkey * 7 % 900 as string) || case when s_suppkey % 7 = 0 then ' A' else '' end end"
M_COUNTRY = "case s_suppkey % 6 when 0 then '' when 1 then 'DE' else country end"
F_CITY = "case p_partkey % 3 when 0 then 'Place ' || cast(p_partkey % 70 as string) else '' end"
F_ZIP = "case p_partkey % 4 when 0 then cast(10000 + p_partkey * 7 % 900 as string) else '' end"
#: short ranges, so that blocks of /24 stay few
SHORT_END = "s_suppkey * 4000037 + s_suppkey % 7 + (s_suppkey * 7919) % 39000"


def build_ranges(spark, d, short: bool = False) -> DataFrame:
    """Seed ranges of a build; without a city on some, with one of the postal table on others."""
    r = ranges(spark, d).selectExpr("s_suppkey", "ip_start", SHORT_END + " as ip_end" if short else "ip_end", "country", f"{B_STATE} as state", f"{B_CITY} as city", "lat", "lon")
    return r.withColumn("has_coords", (F.col("lat") != 0) | (F.col("lon") != 0))


def build_ranges_sql(short: bool = False) -> str:
    return f"(select s_suppkey, ip_start, {SHORT_END if short else 'ip_end'} as ip_end, country, {B_STATE} as state, {B_CITY} as city, lat, lon from {RANGES_SQL})"


def build_feed(spark, d) -> DataFrame:
    code = pick(CODES, "p_partkey").alias("country")
    return feed(spark, d).select("bits", "ip_start", "ip_end", "file", "line", code, pick(STATES, "p_partkey").alias("state"), F.expr(F_CITY).alias("city"), F.expr(F_ZIP).alias("postal"))


BUILD_FEED_SQL = f"""(select p_partkey, bits, ip_start, ip_end, {pick_sql(CODES, "p_partkey")} as country, {pick_sql(STATES, "p_partkey")} as state,
  {F_CITY} as city, {F_ZIP} as postal from {FEED_SQL})"""
COUNTRIES = (("RU", "Russia", "EU", "7", "RUB"), ("US", "United States", "NA", "1", "USD"), ("DE", "Germany", "EU", "49", "EUR"), ("CN", "", "AS", "86", "CNY"))
COUNTRIES_SQL = "(select * from (values " + ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in COUNTRIES) + ") t(code, name, continent, calling, currency))"
ZONES = tuple((k, 4 * k, f"Zone/{k % 7}") for k in range(-360, 360))
ZONES_SQL = "(select k as cell_y, 4 * k as cell_x, 'Zone/' || cast(((k % 7) + 7) % 7 as varchar) as time_zone from (select unnest(generate_series(-360, 359)) as k))"

#: Zones as polygons (name, vertices): a triangle, a concave one, one that lies over both
POLYGONS = (
    ("Zone/A", ((-120.0, -60.0), (100.0, -50.0), (0.0, 80.0))),
    ("Zone/B", ((20.0, -80.0), (160.0, -80.0), (160.0, 80.0), (90.0, -20.0), (20.0, 80.0))),
    ("Zone/0", ((-10.0, -10.0), (30.0, -10.0), (30.0, 10.0), (-10.0, 10.0))),
)
EDGES_SQL = "(select * from (values " + ", ".join(
    f"('{name}', {x1}::double, {y1}::double, {x2}::double, {y2}::double)" for name, ring in POLYGONS for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1])
) + ") t(zone, x1, y1, x2, y2))"
