"""Registry of the core queries, each with the SQL that gives the same rows on DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, ip, text
from ..operators import consensus, enrich, joins, quality
from ..sources import readers
from . import build as plan
from . import derived as src
from . import sqlmerge
from . import sqltwin as tw

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict:
    return dict(_SQL)


# ---- blocks ---------------------------------------------------------------------------------------


@query(f"""select s_suppkey, addr, bits, {tw.address("addr")} || '/' || cast(bits as varchar) as prefix,
  {tw.address("addr")} as start_ip, {tw.address("addr + cast(power(2, 32 - bits) as bigint) - 1")} as end_ip
  from {tw.cover(src.RANGES_SQL, "s_suppkey")}""")
def seed_range_to_cidr(spark, d) -> DataFrame:
    rows = plan.blocks(src.ranges(spark, d)).select("s_suppkey", "addr", "bits")
    a, b = F.col("addr"), F.col("bits")
    return rows.select("*", ip.cidr(a, b).alias("prefix"), ip.to_text(a).alias("start_ip"), ip.to_text(ip.last(a, b)).alias("end_ip"))


@query(f"""select s_suppkey, case when split then addr + i * 256 else addr end as addr, case when split then 24 else bits end as bits
  from (select *, unnest(case when split then generate_series(0, cast(power(2, 24 - bits) as bigint) - 1) else [0] end) as i
        from (select *, bits < 24 and country in ('RU', 'UA', 'KZ') as split from {tw.cover(src.RANGES_SQL, "s_suppkey, country")}))""")
def split_to_24(spark, d) -> DataFrame:
    return plan.blocks(src.ranges(spark, d), split_cis=True).select("s_suppkey", "addr", "bits")


@query(f"""select o_orderkey, {tw.address("addr")} as ip, addr as back, addr - addr % 4096 as base20 from {src.ADDRESSES_SQL}""")
def ip_format_parse(spark, d) -> DataFrame:
    df = src.addresses(spark, d).withColumn("ip", ip.to_text(F.col("addr")))
    return df.select("o_orderkey", "ip", ip.to_int(F.col("ip")).alias("back"), ip.masked(F.col("addr"), 20).alias("base20"))


# ---- joins ----------------------------------------------------------------------------------------


@query(f"""select o_orderkey, addr, p_partkey, bits as matched_bits from
  (select a.o_orderkey, a.addr, f.p_partkey, f.bits,
          row_number() over (partition by a.o_orderkey order by f.bits desc nulls last, f.p_partkey) as rn
   from {src.ADDRESSES_SQL} a left join {src.FEED_SQL} f on a.addr between f.ip_start and f.ip_end) where rn = 1""")
def lpm_geofeed_join(spark, d) -> DataFrame:
    a = src.addresses(spark, d)
    return a.join(joins.longest_prefix(a, src.feed(spark, d), ["p_partkey"], ["file", "line"]), "addr", "left")


@query(f"""select a.o_orderkey, a.addr, case when a.addr <= r.ip_end then r.cc end as cc
  from {src.ADDRESSES_SQL} a asof left join
    (select ip_start, arg_max(ip_end, line) as ip_end, arg_max(cc, line) as cc from {src.REGISTRY_SQL} group by ip_start) r
  on a.addr >= r.ip_start""")
def asof_registry_join(spark, d) -> DataFrame:
    a = src.addresses(spark, d)
    return a.join(joins.as_of_range(a, src.registry(spark, d), ["cc"], ["file", "line"]), "addr", "left").select("o_orderkey", "addr", "cc")


@query(f"""select a.o_orderkey, a.addr, r.s_suppkey from (select o_orderkey, addr % 450000000 as addr from {src.ADDRESSES_SQL}) a
  left join {src.RANGES_SQL} r on a.addr between r.ip_start and r.ip_end""")
def donor_range_join(spark, d) -> DataFrame:
    a = src.addresses(spark, d).withColumn("addr", F.col("addr") % 450000000)
    return a.join(joins.point_in_range(a, src.ranges(spark, d), ["s_suppkey"]), "addr", "left")


@query(f"""select {tw.address("addr")} || '/' || cast(bits as varchar) as matched_prefix, country as country_code, coalesce(nullif(name, ''), country) as country_name,
    coalesce(continent, '') as continent_code, case continent when 'EU' then 'Europe' when 'NA' then 'North America' when 'AS' then 'Asia' else 'Unknown' end as continent_name
  from {tw.cover(src.build_ranges_sql(True), "country")} left join {src.COUNTRIES_SQL} on code = country""")
def country_dim_join(spark, d) -> DataFrame:
    """Countries of a build from the seed alone; some are missing, one has no name."""
    seed = src.build_ranges(spark, d, True).drop("s_suppkey")
    out = plan.build(plan.Inputs(seed=seed, countries=spark.createDataFrame(src.COUNTRIES, plan.COUNTRY)))
    return out.select("matched_prefix", "country_code", "country_name", "continent_code", "continent_name")


# ---- names and text -------------------------------------------------------------------------------


@query(f"select c_custkey, {tw.normalize_name('v')} as out from {src.words_sql(src.NAMES)}")
def normalize_name(spark, d) -> DataFrame:
    return src.words(spark, d, src.NAMES).select("c_custkey", text.normalize_name("v").alias("out"))


@query(f"select c_custkey, {tw.normalize_postal('v')} as out, {tw.scrub_postal('v')} as scrubbed from {src.words_sql(src.POSTALS, tail=False)}")
def normalize_postal(spark, d) -> DataFrame:
    df = src.words(spark, d, src.POSTALS, tail=False)
    return df.select("c_custkey", text.normalize_postal("v").alias("out"), text.scrub_postal("v").alias("scrubbed"))


@query(f"select c_custkey, {tw.scrub('v')} as out from {src.words_sql(src.NAMES, tail=False)}")
def scrub_text(spark, d) -> DataFrame:
    return src.words(spark, d, src.NAMES, tail=False).select("c_custkey", text.scrub("v").alias("out"))


@query(f"select c_custkey, {tw.transliterate('v')} as out, regexp_matches(v, '[\\x{{0400}}-\\x{{04FF}}]') as cyrillic from {src.words_sql(src.CYRILLIC)}")
def transliterate(spark, d) -> DataFrame:
    df = src.words(spark, d, src.CYRILLIC)
    return df.select("c_custkey", text.transliterate("v").alias("out"), text.contains_cyrillic("v").alias("cyrillic"))


@query(f"select c_custkey, {tw.repair('v')} as out from {src.words_sql(src.BROKEN)}")
def mojibake_repair(spark, d) -> DataFrame:
    return src.words(spark, d, src.BROKEN).select("c_custkey", text.repair_mojibake("v").alias("out"))


@query(f"select c_custkey, {tw.artifact('r')} as out from (select c_custkey, {tw.repair('v')} as r from {src.words_sql(src.BROKEN)})")
def text_artifact(spark, d) -> DataFrame:
    return src.words(spark, d, src.BROKEN).select("c_custkey", text.has_artifact(text.repair_mojibake("v")).alias("out"))


@query(f"select * from {tw.city_steps('v', src.words_sql(src.NAMES), 'c_custkey')}")
def clean_city(spark, d) -> DataFrame:
    return src.words(spark, d, src.NAMES).select("c_custkey", text.clean_city("v").alias("out"))


@query(f"select * from {tw.state_steps('v', src.words_sql(src.STATES), 'c_custkey')}")
def clean_state(spark, d) -> DataFrame:
    return src.words(spark, d, src.STATES).select("c_custkey", text.clean_state("v").alias("out"))


@query(f"""select s.c_custkey, case when s.out <> '' and c.out <> '' and lower(s.out) = lower(c.out) then '' else s.out end as state, c.out as city
  from {tw.state_steps("v", src.words_sql(src.STATES, tail=False), "c_custkey")} s
  join {tw.city_steps("v", src.words_sql(src.STATES + src.NAMES, tail=False), "c_custkey")} c using (c_custkey)""")
def dedupe_state_city(spark, d) -> DataFrame:
    df = src.words(spark, d, src.STATES, "s", tail=False).join(src.words(spark, d, src.STATES + src.NAMES, "c", tail=False), "c_custkey")
    state, city = text.dedupe_state_city("s", "c")
    return df.select("c_custkey", state.alias("state"), city.alias("city"))


_PAIRS_SQL = """(select a.p_partkey, a.p_name as a, b.p_name as b, a.p_type as sa, b.p_type as sb
  from part a join part b on b.p_partkey = (a.p_partkey * 7) % (select max(p_partkey) from part) + 1)"""


def _pairs(spark, d) -> DataFrame:
    p = src.table(spark, d, "part")
    last = p.agg(F.max("p_partkey")).first()[0] or 1
    a = p.select("p_partkey", F.col("p_name").alias("a"), F.col("p_type").alias("sa"), (F.col("p_partkey") * 7 % last + 1).alias("o"))
    b = p.select(F.col("p_partkey").alias("o"), F.col("p_name").alias("b"), F.col("p_type").alias("sb"))
    return a.join(b, "o").drop("o")


@query(f"select p_partkey, cast({tw.levenshtein_norm('a', 'b')} as int) as score from {_PAIRS_SQL}")
def levenshtein_score(spark, d) -> DataFrame:
    return _pairs(spark, d).select("p_partkey", text.levenshtein_norm("a", "b").alias("score"))


_NA, _NB = tw.normalize_name("a"), tw.normalize_name("b")
_NAMED_SQL = f"(select p_partkey, {_NA} as a, {_NB} as b, {tw.normalize_name('sa')} as sa, {tw.normalize_name('sb')} as sb from {_PAIRS_SQL})"


@query(f"""select p_partkey, cast(case when a = '' or b = '' then 0 when a = b then 100
    when x >= 90 then x when length(a) >= 4 and length(b) >= 4 and (contains(a, b) or contains(b, a)) then 80
    when x >= 70 then x - 5 else 0 end as int) as score
  from (select *, {tw.levenshtein_norm("a", "b")} as x from {_NAMED_SQL})""")
def city_name_score(spark, d) -> DataFrame:
    blank = F.lit("")
    cand = lambda c: consensus.keyed(F.struct(*[F.lit(0).alias("trust")], *[blank.alias(k) for k in ("source", "country", "state", "city_ru", "postal")], c.alias("city"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), F.lit(False).alias("has_coords")))  # noqa: E731, E501
    df = _pairs(spark, d).select("p_partkey", cand(F.col("a")).alias("x"), cand(F.col("b")).alias("y"))
    return df.select("p_partkey", consensus.name_score(F.col("x"), F.col("y")).alias("score"))


@query(f"""select p_partkey, cast(case when sa = '' or sb = '' then -1 when sa = sb then 100
    when contains(sa, sb) or contains(sb, sa) then 85 when x >= 80 then x else 0 end as int) as score
  from (select *, {tw.levenshtein_norm("sa", "sb")} as x from {_NAMED_SQL})""")
def state_score(spark, d) -> DataFrame:
    df = _pairs(spark, d).select("p_partkey", text.normalize_name("sa").alias("sa"), text.normalize_name("sb").alias("sb"))
    return df.select("p_partkey", consensus.state_score(F.col("sa"), F.col("sb")).alias("score"))


# ---- coordinates ----------------------------------------------------------------------------------

_KM = tw.haversine("lat", "lon", "51.2", "9.3")


@query(f"""select c_custkey, round(km, 6) as km, cast(case when km < 5 then 100 when km < 25 then 85 when km < 75 then 65
    when km < 200 then 40 when km < 500 then 15 else 0 end as int) as score
  from (select *, {_KM} as km from {src.POINTS_SQL})""")
def haversine_bucket(spark, d) -> DataFrame:
    km = geo.haversine_km(F.col("lat"), F.col("lon"), F.lit(51.2), F.lit(9.3))
    df = src.points(spark, d).withColumn("km", km)
    return df.select("c_custkey", F.round("km", 6).alias("km"), geo.proximity(F.col("km")).alias("score"))


@query(f"""select c_custkey, case when isnan(v) or isinf(v) then 0.0 else
    sign(v) * floor(abs(v * 100000.0::double) + 0.5) / 100000.0::double end as v
  from (select c_custkey, case when c_custkey % 50 = 0 then 'nan'::double when c_custkey % 50 = 1 then 'inf'::double
        else lat * 1.2345678901::double end as v from {src.POINTS_SQL})""")
def round_coord(spark, d) -> DataFrame:
    v = F.when(F.expr("c_custkey % 50 = 0"), F.lit(float("nan"))).when(F.expr("c_custkey % 50 = 1"), F.lit(float("inf")))
    df = src.points(spark, d).withColumn("v", v.otherwise(F.col("lat") * 1.2345678901))
    return df.select("c_custkey", geo.round_coord(F.col("v")).alias("v"))


@query(f"""select c_custkey, {tw.box("country", "lat", "lon")} as in_box, {tw.centroid("country", "lat", "lon")} as centroid,
  {tw.island("lat", "lon")} as null_island, {tw.outside("lat", "lon")} as outside from {src.POINTS_SQL}""")
def coordinate_checks(spark, d) -> DataFrame:
    c, y, x = F.col("country"), F.col("lat"), F.col("lon")
    return src.points(spark, d).select(
        "c_custkey", geo.in_country_box(c, y, x).alias("in_box"), geo.is_country_centroid(c, y, x).alias("centroid"),
        geo.null_island(y, x).alias("null_island"), geo.out_of_range(y, x).alias("outside"),
    )


# ---- consensus ------------------------------------------------------------------------------------

_OPINION_SQL = f"""(select p.c_custkey, p.country, {src.pick_sql(src.CODES, "p.c_custkey // 3")} as cc, p.lat, p.lon, v.v as city
  from {src.POINTS_SQL} p join {src.words_sql(src.NAMES, tail=False)} v using (c_custkey))"""


def _opinions(spark, d) -> DataFrame:
    df = src.points(spark, d).join(src.words(spark, d, src.NAMES, tail=False), "c_custkey")
    return df.withColumn("cc", src.pick(src.CODES, "c_custkey div 3"))


@query(f"""select c_custkey, cast(case when city = '' and not keeps then 0 else
    100 - case when cc <> country then 40 else 0 end - case when isl then 25 else 0 end - case when out and not isl then 30 else 0 end
    - case when usable and not box then 20 else 0 end - case when usable and cen then 15 else 0 end end as int) as trust
  from (select *, usable and not cen as keeps from (select *, not isl and not out as usable from
    (select c_custkey, cc, country, {tw.scrub("city")} as city, {tw.island("lat", "lon")} as isl, {tw.outside("lat", "lon")} as out,
      {tw.box("country", "lat", "lon")} as box, {tw.centroid("country", "lat", "lon")} as cen from {_OPINION_SQL})))""")
def trust_score(spark, d) -> DataFrame:
    none = F.lit("")
    c = consensus.candidate("x", F.col("cc"), none, F.col("v"), none, none, F.col("lat"), F.col("lon"), F.lit(True))
    df = _opinions(spark, d).withColumn("c", consensus.scrubbed(c))
    return df.select("c_custkey", consensus.checked(F.col("c"), F.col("country"))["trust"].alias("trust"))


@query(f"""select c_custkey, cast(case when pa = pb then 100 when length(pa) >= 3 and length(pb) >= 3 and left(pa, 3) = left(pb, 3) then 60 else 0 end as int) as postal,
  cast(floor((g * 0.35::double + case when pa = pb then 100 when length(pa) >= 3 and length(pb) >= 3 and left(pa, 3) = left(pb, 3) then 60 else 0 end * 0.20::double)
    / (0.35::double + 0.20::double) + 0.5) as int) as total
  from (select c_custkey, case when km < 5 then 100 when km < 25 then 85 when km < 75 then 65 when km < 200 then 40 when km < 500 then 15 else 0 end as g,
    cast(80000 + c_custkey % 700 as varchar) as pa, cast(80000 + c_custkey % 90 as varchar) as pb
    from (select *, {_KM} as km from {src.POINTS_SQL}))""")  # fmt: skip
def pair_match_score(spark, d) -> DataFrame:
    none, yes = F.lit(""), F.lit(True)
    code = lambda n: F.expr(f"cast(80000 + c_custkey % {n} as string)")
    a = consensus.candidate("a", none, none, none, none, code(700), F.col("lat"), F.col("lon"), yes)
    b = consensus.candidate("b", none, none, none, none, code(90), F.lit(51.2), F.lit(9.3), yes)
    with_trust = lambda c: consensus.keyed(c.withField("trust", F.lit(100)))
    df = src.points(spark, d).select("c_custkey", with_trust(a).alias("a"), with_trust(b).alias("b"))
    df = df.select("c_custkey", consensus.match(F.col("a"), F.col("b")).alias("s"))
    return df.select("c_custkey", F.col("s.postal").alias("postal"), F.col("s.total").alias("total"))


def _merged(spark, d) -> DataFrame:
    """Three opinions on each customer."""
    df = _opinions(spark, d).join(src.words(spark, d, src.STATES, "st", tail=False), "c_custkey")
    none = F.lit("")
    k = F.col("c_custkey")
    other = F.when(k % 3 == 0, src.pick(src.NAMES, "c_custkey + 1")).otherwise(F.col("v"))
    far = F.when(k % 4 == 0, F.col("lat") + 3).otherwise(F.col("lat") + 0.02)
    slots = [
        consensus.candidate("dbip", F.col("country"), F.col("st"), F.col("v"), none, none, F.col("lat"), F.col("lon"), F.lit(True)),
        consensus.candidate("maxmind", F.col("cc"), none, other, none, k.cast("string"), far, F.col("lon"), F.lit(True)),
        consensus.candidate("ip2loc", F.col("country"), F.col("st"), F.col("v"), none, src.pick(src.POSTALS, "c_custkey"), F.lit(0.0), F.lit(0.0), F.lit(False)),
    ]
    return consensus.merge(df.withColumn("candidates", F.array(*slots)).select("c_custkey", "country", "candidates"))


_THREE_SQL = f"""(with o as (select c.*, s.st, {src.pick_sql(src.NAMES, "c_custkey + 1")} as next_name from {_OPINION_SQL} c join {src.words_sql(src.STATES, "st", tail=False)} s using (c_custkey))
  select c_custkey as k, country as seed, 0 as i, 'dbip' as source, country, st as state, city, '' as ru, '' as postal, lat, lon, true as has from o
  union all select c_custkey, country, 1, 'maxmind', cc, '', case when c_custkey % 3 = 0 then next_name else city end, '', cast(c_custkey as varchar),
    case when c_custkey % 4 = 0 then lat + 3 else lat + 0.02::double end, lon, true from o
  union all select c_custkey, country, 2, 'ip2loc', country, st, city, '', {src.pick_sql(src.POSTALS, "c_custkey")}, 0.0::double, 0.0::double, false from o)"""


@query(f"""with recursive {sqlmerge.merged(_THREE_SQL)}
  select k as c_custkey, country as m_country, state as m_state, city as m_city, postal as m_postal, lat as m_lat, lon as m_lon,
    confidence as m_confidence, array_to_string(sources, ',') as sources from merged""")
def merged_record(spark, d) -> DataFrame:
    """Three opinions on each customer, merged."""
    m = F.col("merged")
    return _merged(spark, d).select(
        "c_custkey", *[m[c].alias(f"m_{c}") for c in ("country", "state", "city", "postal", "lat", "lon", "confidence")], F.array_join(m["sources"], ",").alias("sources")
    )


@query(f"""select c_custkey, cast(case when (clone and lat <> 0) or not clone then
    least(100, 25 + 10 + 5) else 0 end as int) as confidence
  from (select c_custkey, lat, true as clone from {src.POINTS_SQL}) where c_custkey % 5 = 0""")
def confidence_singleton(spark, d) -> DataFrame:
    """A single opinion with a city and plausible coordinates."""
    none = F.lit("")
    df = src.points(spark, d).where("c_custkey % 5 = 0")
    c = consensus.candidate("dbip", F.lit("XX"), none, F.lit("Springfield"), none, none, F.col("lat"), F.col("lon"), F.lit(True))
    df = df.select("c_custkey", F.lit("XX").alias("country"), F.array(c).alias("candidates"))
    return consensus.merge(df).select("c_custkey", F.col("merged.confidence").alias("confidence"))


@query(f"""select c_custkey, cast(25 + 10 + case when lat < -90 or lat > 90 or lon < -180 or lon > 180 or (abs(lat) < 0.01 and abs(lon) < 0.01)
    then 0 else 5 end as int) as confidence from {src.POINTS_SQL}""")
def confidence_single_opinion(spark, d) -> DataFrame:
    """confidence_singleton over all customers: coordinates out of range or at null island are cleared."""
    none = F.lit("")
    c = consensus.candidate("dbip", F.lit("XX"), none, F.lit("Springfield"), none, none, F.col("lat"), F.col("lon"), F.lit(True))
    df = src.points(spark, d).select("c_custkey", F.lit("XX").alias("country"), F.array(c).alias("candidates"))
    return consensus.merge(df).select("c_custkey", F.col("merged.confidence").alias("confidence"))


_GRAPH_SQL = """(select c_custkey, c_custkey % 2 = 0 as ab, c_custkey % 3 = 0 as bc, c_custkey % 5 = 0 as ac from customer)"""


@query(f"""select c_custkey, case when ab and (ac or bc) then '0,1,2' when ac and bc then '0,2,1'
    when ab then '0,1' when bc then '1,2' when ac then '0,2' else '0' end as members from {_GRAPH_SQL}""")
def consensus_cluster(spark, d) -> DataFrame:
    """The winning component of a three-node graph of equal trust, in the order of discovery."""
    df = src.table(spark, d, "customer")
    on = lambda n: F.expr(f"c_custkey % {n} = 0")
    edges = lambda *pairs: F.filter(F.array(*[F.when(c, F.lit(j)) for c, j in pairs]), lambda x: x.isNotNull())
    adjacent = F.array(edges((on(2), 1), (on(5), 2)), edges((on(2), 0), (on(3), 2)), edges((on(5), 0), (on(3), 1)))
    df = df.select("c_custkey", adjacent.alias("adj"), F.array(F.lit(9), F.lit(9), F.lit(9)).alias("t"))
    c = consensus.component(F.col("adj"), F.col("t"))
    df = df.select("c_custkey", c.alias("c"))
    return df.select("c_custkey", F.array_join("c", ",").alias("members"))


@query(f"""select c_custkey, cast(coalesce(nullif(list_position(case when country in ('RU', 'UA', 'KZ') then ['geofeed', 'sypex', 'ip2loc', 'maxmind', 'dbip']
    when country in ('CN', 'JP', 'IN') then ['geofeed', 'ip2loc', 'maxmind', 'dbip'] else ['geofeed', 'maxmind', 'ip2loc', 'dbip'] end, s), 0) - 1, 100) as int) as r
  from (select c_custkey, country, {src.pick_sql(("dbip", "geofeed", "maxmind", "ip2loc", "sypex", "other"), "c_custkey // 12")} as s from {src.POINTS_SQL})""")
def primary_rank(spark, d) -> DataFrame:
    s = src.pick(("dbip", "geofeed", "maxmind", "ip2loc", "sypex", "other"), "c_custkey div 12")
    return src.points(spark, d).select("c_custkey", consensus.rank(s, F.col("country")).alias("r"))


# ---- enrichment -----------------------------------------------------------------------------------

_WANTED_SQL = f"""(select c_custkey, {src.pick_sql(src.CODES, "c_custkey")} as country, 'Place ' || cast(c_custkey % 80 as varchar) as city,
  case when c_custkey % 4 = 0 then '' else 'State ' || cast(c_custkey % 4 as varchar) end as state from customer)"""


def _wanted(spark, d) -> DataFrame:
    return src.table(spark, d, "customer").select(
        "c_custkey", src.pick(src.CODES, "c_custkey").alias("country"), F.concat(F.lit("Place "), F.expr("cast(c_custkey % 80 as string)")).alias("city"),
        F.when(F.expr("c_custkey % 4 = 0"), "").otherwise(F.concat(F.lit("State "), F.expr("cast(c_custkey % 4 as string)"))).alias("state"),
    )


_HITS_SQL = f"""(select w.*, p.postal, p.lat, p.lon from {_WANTED_SQL} w left join {src.POSTAL_SQL} p on p.country = w.country and p.place = w.city
  qualify row_number() over (partition by c_custkey order by w.state <> '' and p.state = w.state desc, p.line) = 1)"""


@query(f"select c_custkey, coalesce(postal, '') as postal from {_HITS_SQL}")
def zip_from_city(spark, d) -> DataFrame:
    w = _wanted(spark, d)
    hits = enrich.lookup_city(w.select("country", "city", "state").distinct(), *enrich.postal_by_city(src.postal(spark, d)))
    out = w.join(hits, ["country", "city", "state"], "left")
    return out.select("c_custkey", F.coalesce("hit_postal", F.lit("")).alias("postal"))


@query(f"""select c_custkey, postal <> '' and fills as zip_filled, cast(lat as double) as lat, cast(lon as double) as lon, snapped
  from (select c_custkey, true as fills, coalesce(postal, '') as postal, hit is not null and (km is null or not km > 100) as snapped,
    case when hit is not null and (km is null or not km > 100) then plat else ilat end as lat,
    case when hit is not null and (km is null or not km > 100) then plon else ilon end as lon
  from (select c_custkey, postal, postal as hit, lat as plat, lon as plon, ilat, ilon,
      case when ilat = 0 and ilon = 0 then null else 2 * 6371.0 * asin(sqrt({tw.haversine_a("ilat", "ilon", "lat", "lon")})) end as km
    from (select *, case when c_custkey % 2 = 0 then 0.0::double else coalesce(lat, 1.0) + (c_custkey % 3) * 0.7::double end as ilat,
             case when c_custkey % 2 = 0 then 0.0::double else coalesce(lon, 1.0) end as ilon from {_HITS_SQL})))""")
def snap_coords(spark, d) -> DataFrame:
    w = _wanted(spark, d)
    p = src.postal(spark, d)
    hits = enrich.lookup_city(w.select("country", "city", "state").distinct(), *enrich.postal_by_city(p))
    even = F.expr("c_custkey % 2 = 0")
    blocks = w.join(hits, ["country", "city", "state"], "left").select(
        "c_custkey", "country", F.col("state").alias("m_state"), F.col("city").alias("m_city"), F.lit("").alias("m_postal"),
        F.when(even, 0.0).otherwise(F.coalesce("hit_lat", F.lit(1.0)) + F.expr("c_custkey % 3") * 0.7).alias("m_lat"),
        F.when(even, 0.0).otherwise(F.coalesce("hit_lon", F.lit(1.0))).alias("m_lon"),
    )
    out = enrich.enrich(blocks, p)
    return out.select("c_custkey", "zip_filled", F.col("m_lat").alias("lat"), F.col("m_lon").alias("lon"), "snapped")


_CODE = "cast(10000 + c_custkey % 950 as varchar) || case when c_custkey % 3 = 0 then ' A' else '' end"


@query(f"""with k as (
    select country, postal as code, line, 0 as kind, place, state from {src.POSTAL_SQL}
    union all select country, replace(postal, ' ', ''), line, 1, place, state from {src.POSTAL_SQL} where contains(postal, ' ')),
  f as (select country, code, arg_min(place, line * 2 + kind) as place, arg_min(state, line * 2 + kind) as state from k group by all),
  w as (select c_custkey, {src.pick_sql(src.CODES, "c_custkey")} as country, {_CODE} as code from customer)
  select c_custkey, coalesce(a.place, b.place, '') as city, coalesce(a.state, b.state, '') as state
  from w left join f a on a.country = w.country and a.code = w.code left join f b on b.country = w.country and b.code = replace(w.code, ' ', '')""")
def city_from_zip(spark, d) -> DataFrame:
    code = F.concat(F.expr("cast(10000 + c_custkey % 950 as string)"), F.expr("case when c_custkey % 3 = 0 then ' A' else '' end"))
    w = src.table(spark, d, "customer").select(
        "c_custkey", src.pick(src.CODES, "c_custkey").alias("country"), F.lit("").alias("m_city"), F.lit("").alias("m_state"),
        code.alias("m_postal"), F.lit(0.0).alias("m_lat"), F.lit(0.0).alias("m_lon"),
    )
    out = enrich.enrich(w, src.postal(spark, d))
    return out.select("c_custkey", F.col("m_city").alias("city"), F.col("m_state").alias("state"))


@query(f"""with n as (select country, line, geoname_id, population, unnest(names) as name, unnest(generate_series(0, 3)) as pos from {src.GAZETTEER_SQL})
  select country, {tw.normalize_name("name")} as key, arg_max(geoname_id, population * 1000000000 - line * 10 - pos) as geoname_id from n group by all""")
def gazetteer_best(spark, d) -> DataFrame:
    return enrich.gazetteer_index(src.gazetteer(spark, d))


@query(f"""with k as (
    select country, postal as code, line, 0 as kind, place from {src.POSTAL_SQL}
    union all select country, replace(postal, ' ', ''), line, 1, place from {src.POSTAL_SQL} where contains(postal, ' '))
  select country, code, arg_min(place, line * 2 + kind) as city from k group by all""")
def postal_first(spark, d) -> DataFrame:
    return enrich.city_by_postal(src.postal(spark, d)).select("country", "code", "city")


@query("""select c_custkey, cast(case when c_custkey % 7 = 0 then 20 when c >= 85 and b >= 24 then 25 when c >= 75 then 50 when c >= 50 then 100 else 250 end as int) as km
  from (select c_custkey, c_custkey * 13 % 101 as c, 8 + c_custkey % 25 as b from customer)""")
def accuracy_radius(spark, d) -> DataFrame:
    df = src.table(spark, d, "customer")
    km = enrich.accuracy_radius(F.expr("c_custkey % 7 = 0"), F.expr("c_custkey * 13 % 101"), F.expr("8 + c_custkey % 25"))
    return df.select("c_custkey", km.alias("km"))


_PLACE = "'Town ' || cast(c_custkey as string) || case c_custkey % 6 when 0 then '' when 1 then ' (East-Side)' when 2 then ' (Old Quarter-X)' when 3 then ' ()' when 4 then ' (Süd)' else ' (A) (B C)' end"


@query(f"""select c_custkey, pos - 1 as pos, keys[pos] as key from (select c_custkey, keys, unnest(generate_series(1, len(keys))) as pos from (
  select c_custkey, case c_custkey % 6 when 0 then [t] when 1 then [t || ' east side', 'east side', 'east'] when 2 then [t || ' old quarter x', 'old quarter x', 'old']
    when 3 then [t] when 4 then [t || ' sud', 'sud'] else [t || ' a b c', 'a'] end as keys from (select c_custkey, 'town ' || cast(c_custkey as varchar) as t from customer)))""")
def place_aliases(spark, d) -> DataFrame:
    """Keys of places with and without a name in parentheses."""
    df = src.table(spark, d, "customer").select("c_custkey", F.expr(_PLACE).alias("place"))
    out = df.select("c_custkey", F.posexplode(enrich.place_keys("place")).alias("pos", "key"))
    return out.select("c_custkey", F.col("pos").cast("long").alias("pos"), "key")


@query(f"""select p.c_custkey, coalesce(min(zone), 'UTC') as time_zone from {src.POINTS_SQL} p left join (
    select c_custkey, zone from {src.POINTS_SQL} join {src.EDGES_SQL} on (y1 > lat) <> (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1
    group by c_custkey, zone having count(*) % 2 = 1) h using (c_custkey) group by p.c_custkey""")
def time_zone_polygons(spark, d) -> DataFrame:
    polygons = spark.createDataFrame(src.POLYGONS, "time_zone string, ring array<struct<x:double,y:double>>")
    return enrich.time_zone(src.points(spark, d), polygons).select("c_custkey", "time_zone")


# ---- quality --------------------------------------------------------------------------------------

_CUR, _PREV = src.release_sql("current"), src.release_sql("previous")


@query(f"""select count(*) as rows, count(*) filter (where country_code <> '') as country, count(*) filter (where city_name <> '') as city,
  count(*) filter (where postal_code <> '') as postal, count(*) filter (where city_geoname_id <> '') as geoname,
  count(*) filter (where registry_country_code <> '' and country_code <> '' and registry_country_code <> country_code) as registry_diff,
  count(*) filter (where confidence < 70) as low_confidence,
  count(*) filter (where {tw.artifact(tw.repair("country_name"))} or {tw.artifact(tw.repair("city_name"))}) as bad_artifacts,
  cast(sum(confidence) as bigint) as confidence_sum from {_CUR}""")
def coverage_summary(spark, d) -> DataFrame:
    return quality.coverage(src.release(spark, d, "current"))


@query(f"select country_code, count(*) as n from {_CUR} group by country_code")
def country_counts(spark, d) -> DataFrame:
    return quality.by_country(src.release(spark, d, "current"))


@query(f"""select count(*) filter (where confidence >= 75) as high, count(*) filter (where confidence between 50 and 74) as moderate,
  count(*) filter (where confidence < 50) as low from {_CUR}""")
def confidence_buckets(spark, d) -> DataFrame:
    return quality.confidence_buckets(src.release(spark, d, "current"))


_DIFF_SQL = f"""(select count(*) filter (where b) as common, count(*) filter (where p.matched_prefix is null) as added,
    count(*) filter (where c.matched_prefix is null) as removed,
    count(*) filter (where b and p.country_code <> c.country_code) as country_changed, count(*) filter (where b and p.city_name <> c.city_name) as city_changed,
    count(*) filter (where b and p.country_code <> '' and c.country_code = '') as country_regressions,
    count(*) filter (where b and p.city_name <> '' and c.city_name = '') as city_regressions,
    count(*) filter (where b and p.postal_code <> '' and c.postal_code = '') as postal_regressions,
    count(*) filter (where b and p.city_geoname_id <> '' and c.city_geoname_id = '') as geoname_regressions,
    count(*) filter (where b and c.confidence - p.confidence <= -10) as confidence_drop10,
    count(*) filter (where b and c.confidence - p.confidence >= 10) as confidence_improve10
  from (select p, c, p.matched_prefix is not null and c.matched_prefix is not null as b from {_PREV} p full join {_CUR} c on p.matched_prefix = c.matched_prefix))"""


@query(f"select * from {_DIFF_SQL}")
def release_diff(spark, d) -> DataFrame:
    return quality.difference(src.release(spark, d, "previous"), src.release(spark, d, "current"))


@query(f"select matched_prefix from {_CUR} except select matched_prefix from {_PREV}")
def added_prefixes(spark, d) -> DataFrame:
    return quality.added(src.release(spark, d, "previous"), src.release(spark, d, "current"))


@query(f"select matched_prefix from {_PREV} except select matched_prefix from {_CUR}")
def removed_prefixes(spark, d) -> DataFrame:
    return quality.removed(src.release(spark, d, "previous"), src.release(spark, d, "current"))


@query(f"select matched_prefix from {_PREV} intersect select matched_prefix from {_CUR}")
def common_prefixes(spark, d) -> DataFrame:
    return quality.common(src.release(spark, d, "previous"), src.release(spark, d, "current"))


def _counts_sql(s: str) -> str:
    return f"""(select count(*) as rows, count(*) filter (where city_name <> '') as city, count(*) filter (where city_geoname_id <> '') as geoname,
      count(*) filter (where {tw.artifact(tw.repair("country_name"))} or {tw.artifact(tw.repair("city_name"))}) as bad from {s})"""


@query(f"""select c.bad > 0 or (p.rows > 0 and (c.rows < floor(p.rows * 0.95) or c.city < floor(p.city * 0.95) or c.geoname < floor(p.geoname * 0.90)
    or d.country_regressions > greatest(100, d.common // 1000) or d.city_regressions > greatest(1000, d.common // 100)
    or d.confidence_drop10 > greatest(1000, d.common // 100))) as regression
  from {_counts_sql(_CUR)} c, {_counts_sql(_PREV)} p, {_DIFF_SQL} d""")
def regression_gate(spark, d) -> DataFrame:
    prev, cur = src.release(spark, d, "previous"), src.release(spark, d, "current")
    return quality.regressed(quality.coverage(cur), quality.coverage(prev), quality.difference(prev, cur))


_LINED = f"""(select r.*, list_reduce(list_transform(string_split(split_part(matched_prefix, '/', 1), '.'), lambda x: cast(x as bigint)), lambda a, x: a * 256 + x) as o from {_CUR} r)"""


@query(f"""select matched_prefix, city_name, confidence from (
    select *, row_number() over (partition by matched_prefix order by line desc) as rn from (
      select matched_prefix, trim(city_name) as city_name, case when line % 9 = 0 then 0 else confidence end as confidence, line from (
        select *, o as line from {_LINED} union all select *, o + 100000000000 as line from {_LINED} where o % 5 = 0)))
  where rn = 1""")
def release_dedupe(spark, d) -> DataFrame:
    """Duplicate prefixes (the last row counts) and confidences that are no numbers."""
    r = src.release(spark, d, "current").withColumn("line", ip.to_int(F.substring_index("matched_prefix", "/", 1)))
    r = r.unionByName(r.where("line % 5 = 0").withColumn("line", F.col("line") + 100000000000))
    conf = F.when(F.expr("line % 9 = 0"), "x1").otherwise(F.col("confidence").cast("string"))
    out = quality.load_release(r.withColumn("confidence", conf).withColumn("city_name", F.concat(F.col("city_name"), F.lit(" "))))
    return out.select("matched_prefix", "city_name", "confidence")


@query(f"select matched_prefix from {_CUR} order by matched_prefix limit 25")
def smoke_sample_top25(spark, d) -> DataFrame:
    return quality.smoke_sample(src.release(spark, d, "current"))


# ---- scans: lines to typed rows -------------------------------------------------------------------

_FEED_LINES = src.fields_sql(src.FEED_FIELDS, "part", "p_partkey")
_SEED_ROWS = src.fields_sql(src.SEED_FIELDS, "supplier", "s_suppkey")
_REGISTRY_LINES = src.fields_sql(src.REGISTRY_FIELDS, "customer", "c_custkey")
_PLACE_LINES = src.fields_sql(src.PLACE_FIELDS, "part", "p_partkey")
_TOWN_LINES = src.fields_sql(src.TOWN_FIELDS, "part", "p_partkey")


@query(f"""select k as line, addr as ip_start, addr - addr % n + n - 1 as ip_end, cast(n_bits as int) as bits, upper(trim(country)) as country,
    trim(state) as state, trim(city) as city, trim(postal) as postal
  from (select *, cast(power(2, 32 - n_bits) as bigint) as n from {_FEED_LINES}) where kind = 'row' and n_bits <= 24""")
def geofeed_scan(spark, d) -> DataFrame:
    """Feed lines with comments, short and bad rows, quotes and blocks that are too long."""
    prefix = F.concat("ip", F.lit("/"), F.col("n_bits").cast("string"))
    row = F.concat_ws(",", prefix, "country", "state", src.quoted_field("city"), "postal")
    value = F.when(F.col("kind") == "comment", F.concat(F.lit(" # "), row)).when(F.col("kind") == "short", F.concat_ws(",", prefix, "country", "state"))
    value = value.when(F.col("kind") == "bad", F.concat(F.lit("10.300.0.0/8,"), row)).otherwise(row)
    out = readers.geofeed_rows(src.lines(spark, d, src.FEED_FIELDS, "part", "p_partkey", value))
    return out.select("line", "ip_start", "ip_end", "bits", "country", "state", "city", "postal")


@query(f"""select a as ip_start, a as ip_end, coalesce(country, '') as country, state, city, cast(lat as double) as lat, cast(lon as double) as lon,
    lat <> 0 or lon <> 0 as has_coords from {_SEED_ROWS} where kind = 'row'""")
def seed_scan(spark, d) -> DataFrame:
    """Seed rows as text: addresses of both families, numbers that are none."""
    return readers.seed_rows(src.fields(spark, d, src.SEED_FIELDS, "supplier", "s_suppkey"))


@query(f"""select k as line, upper(trim(cc)) as cc, addr as ip_start, addr + size - 1 as ip_end
  from {_REGISTRY_LINES} where fields = 7 and family = 'ipv4' and size > 0 and length(trim(cc)) = 2 and upper(trim(cc)) <> 'ZZ'""")
def registry_scan(spark, d) -> DataFrame:
    text_of = lambda c: F.col(c).cast("string")
    row = F.concat_ws("|", F.lit("rir"), "cc", "family", "ip", text_of("size"), F.lit("20200101"))
    value = F.when(F.col("fields") == 7, F.concat(row, F.lit("|allocated"))).otherwise(row)
    out = readers.delegation_rows(src.lines(spark, d, src.REGISTRY_FIELDS, "customer", "c_custkey", value))
    return out.select("line", "cc", "ip_start", "ip_end")


@query(f"""select k as line, upper(trim(country)) as country, trim(postal) as postal, trim(place) as place, state,
    cast(case lat when 'north' then 0 else try_cast(lat as double) end as double) as lat, coalesce(try_cast(lon as double), 0) as lon
  from {_PLACE_LINES} where fields = 12 and trim(postal) <> '' and trim(place) <> ''""")
def postal_scan(spark, d) -> DataFrame:
    value = src.separated({0: "country", 1: "postal", 2: "place", 3: "state", 9: "lat", 10: "lon"}, "fields")
    out = readers.postal_rows(src.lines(spark, d, src.PLACE_FIELDS, "part", "p_partkey", value))
    return out.select(F.col("line.line").alias("line"), "country", "postal", "place", "state", "lat", "lon")


@query(f"""select k as line, cast(number as bigint) as geoname_id, name, 'f2' as asciiname, 'f3' as alternatenames, upper(trim(country)) as country,
    coalesce(try_cast(population as bigint), 0) as population
  from {_TOWN_LINES} where fields = 15 and class = 'P' and coalesce(try_cast(number as bigint), 0) > 0 and trim(country) <> ''""")
def gazetteer_scan(spark, d) -> DataFrame:
    value = src.separated({0: "number", 1: "name", 6: "class", 8: "country", 14: "population"}, "fields")
    out = readers.gazetteer_rows(src.lines(spark, d, src.TOWN_FIELDS, "part", "p_partkey", value))
    return out.select(F.col("line.line").alias("line"), "geoname_id", "name", "asciiname", "alternatenames", "country", "population")


@query(f"""select c_custkey, case v when 'москва' then 'moscow' when 'казань' then 'kazan' when 'санкт петербург' then 'st petersburg' end as known
  from {src.words_sql(src.KNOWN, tail=False)}""")
def known_city(spark, d) -> DataFrame:
    return src.words(spark, d, src.KNOWN, tail=False).select("c_custkey", text.known_latin("v").alias("known"))


@query("""select c_custkey, case when t >= 80 then 4 when t >= 60 then 3 when t >= 40 then 2 when t >= 20 then 1 else 0 end as level
  from (select c_custkey, cast(c_custkey * 7 % 1010 as double) / 10 as t from customer)""")
def agreement_level(spark, d) -> DataFrame:
    t = F.expr("cast(c_custkey * 7 % 1010 as double) / 10")
    return src.table(spark, d, "customer").select("c_custkey", consensus.agreement(t).alias("level"))


@query(f"""select c_custkey, coalesce(try_cast(case when regexp_matches(v, '[ ]') or regexp_matches(v, '^[+-]?[0-9.].*[fFdDlLsSyY]$') then null else v end as double), 0) as out
  from {src.words_sql(src.FLOATS, tail=False)}""")
def lenient_float(spark, d) -> DataFrame:
    return src.words(spark, d, src.FLOATS, tail=False).select("c_custkey", text.lenient_float("v").alias("out"))


@query(f"""select country_code, rows, filled, case when rows = 0 then 0 else cast(filled as double) * 100 / rows end as pct
  from (select country_code, count(*) as rows, count(*) filter (where city_name <> '') as filled from {_CUR} group by country_code)""")
def fill_ratios(spark, d) -> DataFrame:
    """Shares of filled cities, as the report gives them."""
    r = src.release(spark, d, "current").groupBy("country_code").agg(F.count("*").alias("rows"), F.count_if(F.col("city_name") != "").alias("filled"))
    return r.select("country_code", "rows", "filled", quality.percent(F.col("filled"), F.col("rows")).alias("pct"))


# ---- the whole build ------------------------------------------------------------------------------


_BLOCKS_SQL = f"(select addr, bits, s_suppkey, country, state, city, lat, lon from {tw.cover(src.build_ranges_sql(), 's_suppkey, country, state, city, lat, lon')})"
_SHORT_SQL = f"""(select case when split then addr + j * 256 else addr end as addr, cast(case when split then 24 else bits end as int) as bits, s_suppkey, country, state, city, lat, lon
  from (select *, unnest(case when split then generate_series(0, cast(power(2, 24 - bits) as bigint) - 1) else [0] end) as j
        from (select *, bits < 24 and country in ('RU', 'UA', 'KZ') as split from {tw.cover(src.build_ranges_sql(True), "s_suppkey, country, state, city, lat, lon")})))"""


def _opinions_sql(blocks: str, every: bool) -> str:
    """What the seed, the feed and ip2loc (and with ``every`` maxmind and sypex) say of each block."""
    out = f"""with b as (select * from {blocks}),
      g as (select b.addr, b.country as seed, f.* from b join {src.BUILD_FEED_SQL} f on b.addr between f.ip_start and f.ip_end
        qualify row_number() over (partition by b.addr order by f.bits desc, f.p_partkey) = 1)
      select addr as k, country as seed, 0 as i, 'dbip' as source, country, state, city, '' as ru, '' as postal, lat, lon, lat <> 0 or lon <> 0 as has from b
      union all select addr, seed, 1, 'geofeed', country, state, city, '', postal, 0.0::double, 0.0::double, false from g
      union all select addr, country, 3, 'ip2loc', case when s_suppkey % 9 = 0 then country else upper(country) end, state, {src.I_CITY}, '', {src.I_ZIP},
        cast(cast(lat as float) as double), cast(cast(lon as float) as double), cast(lat as float) <> 0 or cast(lon as float) <> 0 from b"""
    if every:
        out += f"""
      union all select addr, country, 2, 'maxmind', coalesce(nullif({src.M_COUNTRY}, ''), country), 'State 1', city, '', cast(s_suppkey % 100 as varchar), lat + 0.02::double, lon,
        lat + 0.02::double <> 0 or lon <> 0 from b where s_suppkey % 4 <> 1
      union all select addr, country, 4, 'sypex', country, state, case when s_suppkey % 2 = 0 then city else '' end, {src.pick_sql(src.CYRILLIC, "s_suppkey")}, '',
        lat, lon - 0.03::double, lat <> 0 or lon - 0.03::double <> 0 from b where country in ('RU', 'UA', 'KZ')"""
    return f"({out})"


def _release_sql(every: bool = False) -> str:
    blocks = _SHORT_SQL if every else _BLOCKS_SQL
    return sqlmerge.release(blocks, _opinions_sql(blocks, every), src.REGISTRY_SQL, src.POSTAL_SQL, src.GAZETTEER_SQL, src.COUNTRIES_SQL, src.ZONES_SQL if every else "")


def _inputs(spark, d, every: bool = False) -> plan.Inputs:
    seed = src.build_ranges(spark, d, every)
    code = F.when(F.expr("s_suppkey % 9 = 0"), "-").otherwise(F.concat(F.lit(" "), F.lower("country")))
    ip2loc = seed.select(
        "ip_start", "ip_end", code.alias("country_short"), F.col("state").alias("region"), F.expr(src.I_CITY).alias("city"), F.expr(src.I_ZIP).alias("zipcode"),
        F.col("lat").cast("float").alias("latitude"), F.col("lon").cast("float").alias("longitude"),
    )
    more = {}
    if every:
        english = lambda c: F.create_map(F.lit("en"), c)
        more["maxmind"] = seed.where("s_suppkey % 4 <> 1").select(
            "ip_start", "ip_end", F.struct(english(F.col("city")).alias("names")).alias("city"), F.struct(F.expr(src.M_COUNTRY).alias("iso_code")).alias("country"),
            F.array(F.struct(english(F.lit("State 1")).alias("names"))).alias("subdivisions"), F.struct(F.expr("cast(s_suppkey % 100 as string)").alias("code")).alias("postal"),
            F.struct((F.col("lat") + 0.02).alias("latitude"), F.col("lon").alias("longitude")).alias("location"),
        )
        more["sypex"] = seed.select(
            "ip_start", "ip_end", F.lower("country").alias("country_iso"), F.when(F.expr("s_suppkey % 2 = 0"), F.col("city")).otherwise("").alias("city_en"),
            src.pick(src.CYRILLIC, "s_suppkey").alias("city_ru"), F.col("state").alias("region_en"), F.col("lat").alias("latitude"), (F.col("lon") - 0.03).alias("longitude"),
        )
        more["zones"] = spark.createDataFrame(src.ZONES, "cell_y long, cell_x long, time_zone string")
    return plan.Inputs(
        seed=seed.drop("s_suppkey"), geofeed=src.build_feed(spark, d), ip2loc=ip2loc, registry=src.registry(spark, d), postal=src.postal(spark, d),
        gazetteer=src.gazetteer(spark, d), countries=spark.createDataFrame(src.COUNTRIES, plan.COUNTRY), **more,
    )


_BUILT = "1970-01-01T00:00:00Z"


@query(f"with recursive {_release_sql()} select {sqlmerge.CSV} from release")
def release_build(spark, d) -> DataFrame:
    return plan.as_csv(plan.build(_inputs(spark, d), built_at=_BUILT))


@query(f"with recursive {_release_sql(True)} select {sqlmerge.CSV} from release")
def release_build_all_sources(spark, d) -> DataFrame:
    """All five sources, blocks of CIS countries as /24, zones."""
    return plan.as_csv(plan.build(_inputs(spark, d, True), built_at=_BUILT))


@query(f"""with recursive {_release_sql()} select matched_prefix, confidence, country_code, calling_code, currency_code, country_code in ('DE', 'FR', 'IT') as is_eu_member,
  geoname as city_geoname_id, lat as latitude, lon as longitude, city_name, accuracy_radius_km from release""")
def release_record_nested(spark, d) -> DataFrame:
    """Fields of the lookup record."""
    out = plan.nested(plan.build(_inputs(spark, d), built_at=_BUILT))
    about = F.col("country_metadata")[F.col("location.country_code")]
    return out.select(
        "matched_prefix", "confidence", F.map_keys("country_metadata")[0].alias("country_code"), *[about[c].alias(c) for c in ("calling_code", "currency_code", "is_eu_member")],
        *[F.col(f"location.{c}").alias(c) for c in ("city_geoname_id", "latitude", "longitude", "city_name", "accuracy_radius_km")],
    )


@query(f"""select s_suppkey, {tw.address("addr")} || '/' || cast(bits as varchar) as matched_prefix, country as country_code,
  format('{{:.5f}}', lat) as latitude from {tw.cover(src.RANGES_SQL, "s_suppkey, country, lat")}""")
def seed_only_build(spark, d) -> DataFrame:
    """The smallest build: ranges to blocks with the seed's country and coordinates as text."""
    rows = plan.blocks(src.ranges(spark, d))
    return rows.select(
        "s_suppkey", ip.cidr(F.col("addr"), F.col("bits")).alias("matched_prefix"), F.col("country").alias("country_code"),
        F.format_string("%.5f", F.col("lat")).alias("latitude"),
    )


@query(f"""with recursive {_release_sql()} select count(*) filter (where confidence >= 75) as high, count(*) filter (where confidence >= 50 and confidence < 75) as moderate,
  count(*) filter (where confidence < 50) as low, count(*) filter (where snapped) as snapped, count(*) filter (where zip_filled) as zip_filled,
  count(*) filter (where city_filled) as city_filled from release""")
def build_counters(spark, d) -> DataFrame:
    return plan.counters(plan.build(_inputs(spark, d)))
