"""The consensus as relational SQL (pairs are joined, fields picked by arg_min), for the twins of the catalog."""

from __future__ import annotations

from ..functions import fixed
from . import sqltwin as tw


def _listed(values) -> str:
    return "[" + ", ".join(tw.lit(v) for v in values) + "]"


def _known(c: str) -> str:
    return f"({_listed(fixed.CITIES.values())})[nullif(list_position({_listed(fixed.CITIES)}, {c}), 0)]"


def _name(a: str, b: str) -> str:
    """Score of the name columns ``a`` of x and ``b`` of y, with their c_ (Cyrillic), t_ and w_ columns."""
    x, y, cx, cy = f"x.{a}", f"y.{b}", f"x.c_{a}", f"y.c_{b}"
    latin, other, known = f"(case when {cx} then {y} else {x} end)", f"(case when {cx} then x.t_{a} else y.t_{b} end)", f"(case when {cx} then x.w_{a} else y.w_{b} end)"
    d, dt = tw.levenshtein_norm(x, y), tw.levenshtein_norm(other, latin)
    return f"""(case when {x} = '' or {y} = '' then 0 when {x} = {y} then 100
      when {cx} <> {cy} then case when coalesce({known} = {latin}, false) then 100 when {other} = {latin} then 95 when {dt} >= 88 then {dt} - 5 else 0 end
      when {d} >= 90 then {d} when strlen({x}) >= 4 and strlen({y}) >= 4 and (contains({x}, {y}) or contains({y}, {x})) then 80
      when {d} >= 70 then {d} - 5 else 0 end)"""


def merged(source: str) -> str:
    """CTEs that end with ``merged`` (k, country, state, city, postal, lat, lon, sources, n_valid, n_cluster, confidence),
    from rows (k, seed, i, source, country, state, city, ru, postal, lat, lon, has) of the opinions on k."""
    km = tw.haversine("x.lat", "x.lon", "y.lat", "y.lon")
    ds = tw.levenshtein_norm("x.ks", "y.ks")
    first = lambda c: f"substr(hex(encode({c})), 1, 6)"
    place = lambda order: f"coalesce(nullif(list_position({_listed(order)}, v.source), 0) - 1, {fixed.UNRANKED})"
    part = lambda c, w: f"case when {c} then {{}} else 0.0::double end".format(w)
    total = f"""(geo * 0.35::double + {part("named", "name * 0.30::double")} + {part("postal >= 0", "postal * 0.20::double")} + {part("state >= 0", "state * 0.15::double")})
      / (0.35::double + {part("named", "0.30::double")} + {part("postal >= 0", "0.20::double")} + {part("state >= 0", "0.15::double")})"""
    cyrillic = lambda c: f"regexp_matches({c}, '[\\x{{0400}}-\\x{{04FF}}]')"
    return f"""m0 as (select * from {source}),
    m1 as (select k, seed, i, source, country, {tw.scrub("state")} as state, {tw.scrub("city")} as city, {tw.scrub("ru")} as ru, {tw.scrub_postal("postal")} as postal, lat, lon, has from m0),
    m2 as (select *, {tw.island("lat", "lon")} as z, not {tw.island("lat", "lon")} and {tw.outside("lat", "lon")} as o,
      {tw.box("seed", "lat", "lon")} as box, {tw.centroid("seed", "lat", "lon")} as cen from m1),
    m3 as (select *, has and not z and not o as usable from m2),
    m4 as (select *, usable and not cen as keeps, 100 - case when country <> '' and seed <> '' and country <> seed then 40 else 0 end
      - case when has and z then 25 else 0 end - case when has and o then 30 else 0 end
      - case when usable and seed <> '' and not box then 20 else 0 end - case when usable and cen then 15 else 0 end as t from m3),
    m5 as (select k, seed, i, source, country, state, city, ru, postal, case when has and (z or o) then 0.0 else lat end as lat,
      case when has and (z or o) then 0.0 else lon end as lon, keeps as has,
      case when city = '' and ru = '' and postal = '' and not keeps then 0 else greatest(t, 0) end as trust from m4),
    m6 as (select * exclude (i), row_number() over (partition by k order by i) - 1 as i, count(*) over (partition by k) as n from m5 where trust > 0),
    m7 as (select *, {tw.normalize_name("city")} as kc, {tw.normalize_name("ru")} as kr, {tw.normalize_name("state")} as ks, {tw.normalize_postal("postal")} as kp from m6),
    m8 as (select *, {cyrillic("kc")} as c_kc, {cyrillic("kr")} as c_kr, {tw.transliterate("kc")} as t_kc, {tw.transliterate("kr")} as t_kr,
      {_known("kc")} as w_kc, {_known("kr")} as w_kr from m7),
    pairs as (select x.k, x.i as a, y.i as b, (x.city <> '' or x.ru <> '') and (y.city <> '' or y.ru <> '') as named,
        case when not (x.has and y.has) then 50 when {km} < 5 then 100 when {km} < 25 then 85 when {km} < 75 then 65 when {km} < 200 then 40 when {km} < 500 then 15 else 0 end as geo,
        greatest({_name("kc", "kc")}, {_name("kr", "kr")}, {_name("kc", "kr")}, {_name("kr", "kc")}) as name,
        case when x.postal = '' or y.postal = '' then -1 when x.kp = y.kp then 100
          when strlen(x.kp) >= 3 and strlen(y.kp) >= 3 and {first("x.kp")} = {first("y.kp")} then 60 else 0 end as postal,
        case when x.state = '' or y.state = '' or x.ks = '' or y.ks = '' then -1 when x.ks = y.ks then 100
          when contains(x.ks, y.ks) or contains(y.ks, x.ks) then 85 when {ds} >= 80 then {ds} else 0 end as state
      from m8 x join m8 y on x.k = y.k and x.i < y.i),
    scored as (select *, case when t >= 80 then 4 when t >= 60 then 3 when t >= 40 then 2 when t >= 20 then 1 else 0 end as level
      from (select *, floor({total} + 0.5) as t from pairs)),
    edges as (select k, a as x, b as y from scored where level >= 3 union all select k, b, a from scored where level >= 3),
    near as (select v.k, v.i, v.trust, coalesce(list(e.y order by e.y) filter (where e.y is not null), []) as adj
      from m8 v left join edges e on e.k = v.k and e.x = v.i group by v.k, v.i, v.trust),
    graph as (select k, list(adj order by i) as adj, list(trust order by i) as trusts from near group by k),
    walk as (select k, i as start, [i] as acc, 1 as at from m8
      union all select w.k, w.start, w.acc || list_filter(g.adj[w.acc[w.at] + 1], lambda x: not list_contains(w.acc, x)), w.at + 1
      from walk w join graph g on g.k = w.k where w.at <= len(w.acc)),
    found as (select w.k, w.start, w.acc, list_sum(list_transform(w.acc, lambda x: g.trusts[x + 1])) as trust
      from walk w join graph g on g.k = w.k where w.at = len(w.acc) + 1 and w.start = list_min(w.acc)),
    won as (select k, acc from found qualify row_number() over (partition by k order by len(acc) desc, trust desc, start) = 1),
    members as (select k, unnest(acc) as i, generate_subscripts(acc, 1) as pos, len(acc) as n_cluster from won),
    prime as (select v.*, m.n_cluster from members m join m8 v on v.k = m.k and v.i = m.i
      qualify row_number() over (partition by v.k order by case when v.seed in ({", ".join(map(tw.lit, fixed.CIS))}) then {place(fixed.PRIORITY_CIS)}
        when v.seed in ({", ".join(map(tw.lit, fixed.ASIA))}) then {place(fixed.PRIORITY_ASIA)} else {place(fixed.PRIORITY_DEFAULT)} end, -v.trust, m.pos) = 1),
    donors as (select v.k, m.pos, v.source, v.state, v.city, v.postal, v.lat, v.lon, v.has, s.level, s.state as likely
      from members m join m8 v on v.k = m.k and v.i = m.i join prime p on p.k = m.k
      join scored s on s.k = m.k and s.a = least(v.i, p.i) and s.b = greatest(v.i, p.i) where v.source <> p.source),
    given as (select k, list(source order by pos) as order_in,
        arg_min(city, pos) filter (where level >= 3 and city <> '') as city, arg_min(source, pos) filter (where level >= 3 and city <> '') as by_city,
        arg_min(state, pos) filter (where level >= 2 and state <> '') as state, arg_min(source, pos) filter (where level >= 2 and state <> '') as by_state,
        arg_min(postal, pos) filter (where postal <> '' and (level >= 3 or level = 2 and likely > 50)) as postal,
        arg_min(source, pos) filter (where postal <> '' and (level >= 3 or level = 2 and likely > 50)) as by_postal,
        arg_min(lat, pos) filter (where level >= 3 and has) as lat, arg_min(lon, pos) filter (where level >= 3 and has) as lon,
        arg_min(source, pos) filter (where level >= 3 and has) as by_coords
      from donors group by k),
    outside as (select v.k, list(v.source order by v.i) as order_out,
        arg_min(v.postal, v.i) filter (where v.trust >= 50 and v.postal <> '') as postal, arg_min(v.source, v.i) filter (where v.trust >= 50 and v.postal <> '') as by_postal,
        arg_min(v.state, v.i) filter (where v.trust >= 50 and v.state <> '') as state, arg_min(v.source, v.i) filter (where v.trust >= 50 and v.state <> '') as by_state
      from m8 v where not exists (select 1 from members m join m8 u on u.k = m.k and u.i = m.i where m.k = v.k and u.source = v.source) group by v.k),
    filled as (select p.k, case when p.country <> '' then p.country else p.seed end as country,
        coalesce(nullif(p.state, ''), g.state, o.state, '') as state, coalesce(nullif(p.city, ''), g.city, '') as city,
        coalesce(nullif(p.postal, ''), g.postal, o.postal, '') as postal,
        case when p.lat = 0 and p.lon = 0 then coalesce(g.lat, p.lat) else p.lat end as lat, case when p.lat = 0 and p.lon = 0 then coalesce(g.lon, p.lon) else p.lon end as lon,
        [p.source] || list_filter(coalesce(g.order_in, []), lambda s: list_contains([case when p.city = '' then g.by_city end, case when p.state = '' then g.by_state end,
          case when p.postal = '' then g.by_postal end, case when p.lat = 0 and p.lon = 0 then g.by_coords end], s))
        || list_transform(list_filter(coalesce(o.order_out, []), lambda s: list_contains([case when p.postal = '' and g.postal is null then o.by_postal end,
          case when p.state = '' and g.state is null then o.by_state end], s)), lambda s: s || '?') as sources,
        p.n as n_valid, p.n_cluster
      from prime p left join given g on g.k = p.k left join outside o on o.k = p.k),
    merged as (select b.k, coalesce(f.country, b.seed) as country, coalesce(f.state, '') as state, coalesce(f.city, '') as city, coalesce(f.postal, '') as postal,
        coalesce(f.lat, 0.0)::double as lat, coalesce(f.lon, 0.0)::double as lon, coalesce(f.sources, []) as sources,
        coalesce(f.n_valid, 0) as n_valid, coalesce(f.n_cluster, 0) as n_cluster,
        cast(case when f.k is null then 0 else least(100, case when n_cluster <= 1 then 25 when n_cluster = 2 then 50 else 65 end + case when n_cluster = n_valid and n_valid >= 2 then 5 else 0 end
          + case when city <> '' then 10 else 0 end + case when state <> '' then 5 else 0 end + case when postal <> '' then 10 else 0 end
          + case when lat <> 0 or lon <> 0 then 5 else 0 end) end as int) as confidence
      from (select distinct k, seed from m0) b left join filled f on f.k = b.k)"""


def release(blocks: str, opinions: str, registry: str, postal: str, gazetteer: str, countries: str, zones: str = "") -> str:
    """CTEs that end with ``release`` (the columns of a build and its flags): blocks (addr, bits, country), opinions
    as ``merged`` takes them with k = addr, registry (ip_start, ip_end, cc, line), postal and gazetteer as derived,
    countries (code, name, continent, calling, currency), zones (cell_y, cell_x, time_zone)."""
    km = f"(2 * 6371.0 * asin(sqrt({tw.haversine_a('m.lat', 'm.lon', 'h.lat', 'h.lon')})))"
    rounded = lambda c: f"(case when isnan({c}) or isinf({c}) then 0.0 else sign({c}) * floor(abs({c} * 100000.0::double) + 0.5) / 100000.0::double end)"
    compact = tw.normalize_postal("m_postal")
    zone = "'UTC'"
    if zones:
        zone = f"coalesce((select max(time_zone) from {zones} z where z.cell_y = floor(f.lat / 0.25) and z.cell_x = floor(f.lon / 0.25)), 'UTC')"
    return f"""blocks as (select * from {blocks}), {merged(opinions)},
    reg as (select b.addr, case when b.addr <= r.ip_end then r.cc end as cc from (select distinct addr from blocks) b
      asof left join (select ip_start, arg_max(ip_end, line) as ip_end, arg_max(cc, line) as cc from {registry} where ip_start <= ip_end group by ip_start) r on b.addr >= r.ip_start),
    base as (select b.addr, b.bits, b.country as seed, coalesce(r.cc, b.country) as registry, m.country, m.state, m.city, m.postal, m.lat, m.lon, m.confidence
      from blocks b join merged m on m.k = b.addr left join reg r on r.addr = b.addr),
    places as (select country, {tw.normalize_name("place")} as key, {tw.normalize_name("state")} as state_norm, line, postal, lat, lon from {postal}),
    wanted as (select distinct seed, city, state from base where city <> ''),
    cleaned as (select seed, city, state, {tw.normalize_name("out")} as key from {tw.city_steps("city", "wanted", "seed, city, state")}),
    hits as (select w.seed, w.city, w.state, p.postal, p.lat, p.lon from cleaned w join places p on p.country = w.seed and p.key = w.key
      qualify row_number() over (partition by w.seed, w.city, w.state order by (w.state <> '' and p.state_norm = {tw.normalize_name("w.state")}) desc, p.line) = 1),
    snapped as (select m.*, h.postal as hit, h.lat as hit_lat, h.lon as hit_lon,
        h.lat is not null and (not (m.lat <> 0 or m.lon <> 0) or not coalesce({km} > 100, false)) as snap
      from base m left join hits h on h.seed = m.seed and h.city = m.city and h.state = m.state),
    zipped as (select addr, bits, seed, registry, country, state, city, confidence, snap, postal = '' and city <> '' and coalesce(hit <> '', false) as zip_filled,
        case when postal = '' and city <> '' and coalesce(hit <> '', false) then hit else postal end as m_postal,
        case when snap then hit_lat else lat end as lat, case when snap then hit_lon else lon end as lon from snapped),
    codes as (select country, code, arg_min(place, o) as place, arg_min(state, o) as state, arg_min(lat, o) as lat, arg_min(lon, o) as lon from (
        select country, postal as code, line * 2 as o, place, state, lat, lon from {postal}
        union all select country, {tw.normalize_postal("postal")}, line * 2 + 1, place, state, lat, lon from {postal} where {tw.normalize_postal("postal")} <> postal)
      group by country, code),
    backed as (select z.*, coalesce(a.place, b.place) as by_code, case when a.code is not null then a.state else b.state end as code_state,
        case when a.code is not null then a.lat else b.lat end as code_lat, case when a.code is not null then a.lon else b.lon end as code_lon
      from zipped z left join codes a on z.city = '' and z.m_postal <> '' and a.country = z.seed and a.code = z.m_postal
      left join codes b on z.city = '' and z.m_postal <> '' and b.country = z.seed and b.code = {compact}),
    full_rows as (select addr, bits, seed, registry, country, confidence, zip_filled, m_postal, city = '' and by_code is not null as city_filled,
        case when city = '' and by_code is not null then by_code else city end as m_city,
        case when city = '' and by_code is not null and state = '' then code_state else state end as m_state,
        snap or (city = '' and by_code is not null and not (lat <> 0 or lon <> 0)) as snapped,
        case when city = '' and by_code is not null and not (lat <> 0 or lon <> 0) then code_lat else lat end as m_lat,
        case when city = '' and by_code is not null and not (lat <> 0 or lon <> 0) then code_lon else lon end as m_lon from backed),
    f as (select *, {rounded("m_lat")} as lat, {rounded("m_lon")} as lon from full_rows),
    named as (select country, {tw.normalize_name("out")} as key, geoname_id, population, line, pos from
      {tw.city_steps("name", f"(select country, line, geoname_id, population, unnest(names) as name, unnest(generate_series(0, 3)) as pos from {gazetteer})", "country, geoname_id, population, line, pos")}),
    numbers as (select country, key, arg_max(geoname_id, population * 1000000000 - line * 10 - pos) as geoname_id from named where key <> '' group by country, key),
    cities as (select m_city, out from {tw.city_steps("m_city", "(select distinct m_city from f)", "m_city")}),
    states as (select m_state, out from {tw.state_steps("m_state", "(select distinct m_state from f)", "m_state")}),
    release as (select {tw.address("f.addr")} as start_ip, {tw.address("f.addr + cast(power(2, 32 - f.bits) as bigint) - 1")} as end_ip,
        {tw.address("f.addr")} || '/' || cast(f.bits as varchar) as matched_prefix, coalesce(d.continent, '') as continent_code,
        coalesce(case d.continent when 'EU' then 'Europe' when 'NA' then 'North America' when 'AS' then 'Asia' end, 'Unknown') as continent_name,
        f.country as country_code, coalesce(nullif(d.name, ''), f.country) as country_name, coalesce(nullif(f.registry, ''), f.country) as registry_country_code,
        case when s.out <> '' and c.out <> '' and lower(s.out) = lower(c.out) then '' else s.out end as subdivision_name,
        n.geoname_id as geoname, c.out as city_name, f.m_postal as postal_code, f.lat as lat, f.lon as lon, {zone} as time_zone,
        case when f.snapped then 20 when f.confidence >= 85 and f.bits >= 24 then 25 when f.confidence >= 75 then 50 when f.confidence >= 50 then 100 else 250 end as accuracy_radius_km,
        f.confidence, coalesce(d.calling, '') as calling_code, coalesce(d.currency, '') as currency_code, f.snapped, f.zip_filled, f.city_filled
      from f join cities c on c.m_city = f.m_city join states s on s.m_state = f.m_state
      left join numbers n on n.country = f.country and n.key = {tw.normalize_name("c.out")} left join {countries} d on d.code = f.country)"""


CSV = """start_ip, end_ip, matched_prefix, continent_code, continent_name, country_code, country_name, registry_country_code, subdivision_name,
  coalesce(cast(geoname as varchar), '') as city_geoname_id, city_name, postal_code, format('{:.5f}', lat) as latitude, format('{:.5f}', lon) as longitude,
  time_zone, cast(accuracy_radius_km as varchar) as accuracy_radius_km, cast(confidence as varchar) as confidence, '1970-01-01T00:00:00Z' as source_updated_at"""
