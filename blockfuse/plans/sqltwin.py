"""DuckDB expressions for the scalar functions, for the SQL twins of the catalog."""

from __future__ import annotations

from ..functions import fixed, text

WS = r"\s\x0B\x{85}\p{Z}"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim(c):
    return f"regexp_replace(regexp_replace({c}, '^[{WS}]+', ''), '[{WS}]+$', '')"


def scrub(c):
    low = f"lower({trim(c)})"
    parts = " or ".join(f"contains({low}, {lit(p)})" for p in fixed.PLACEHOLDER_PARTS)
    names = ", ".join(lit(p) for p in fixed.PLACEHOLDERS)
    return f"case when {low} in ({names}) or {parts} then '' else {trim(c)} end"


def scrub_postal(c):
    return f"case when regexp_full_match({scrub(c)}, '[0 -]*') then '' else {scrub(c)} end"


def normalize_postal(c):
    return f"regexp_replace(upper({trim(c)}), '[ -]', '', 'g')"


def normalize_name(c):
    fold = text._FOLD
    s = f"translate(lower({trim(c)}), {lit(''.join(map(chr, fold)))}, {lit(''.join(map(chr, fold.values())))})"
    s = f"replace({s}, 'ß', 'ss')"
    s = f"regexp_replace({s}, '^(?:saint-|saint |st\\. |st-|st )', 'st ')"
    s = f"regexp_replace({s}, '[^\\p{{L}}\\p{{Nd}}{WS}_-]', '', 'g')"
    return f"trim(regexp_replace({s}, '[{WS}_-]+', ' ', 'g'))"


def replaced(c, pairs):
    for a, b in pairs:
        c = f"replace({c}, {lit(a)}, {lit(b)})"
    return c


def repair(c):
    return replaced(c, text.mojibake_pairs())


def transliterate(c):
    both = {**fixed.CYRILLIC_LETTERS, **{k.upper(): v for k, v in fixed.CYRILLIC_LETTERS.items()}}
    return replaced(c, both.items())


def artifact(c):
    tests = [f"contains({c}, {lit(p)})" for p in fixed.ARTIFACTS] + [f"contains(lower({c}), {lit(p)})" for p in fixed.ARTIFACTS_LOWER]
    return "(" + " or ".join(tests) + ")"


def strip_prefix(c, affixes):
    """Lateral steps would be clearer; a CASE keeps it one expression."""
    return "case " + " ".join(f"when starts_with({c}, {lit(p)}) then {trim(f'substr({c}, {len(p) + 1})')}" for p in affixes) + f" else {c} end"


def strip_suffix(c, affixes, spare=None):
    more = lambda p: f" and strlen({c}) > {len(p) + spare}" if spare is not None else ""
    return "case " + " ".join(f"when ends_with({c}, {lit(p)}){more(p)} then {trim(f'left({c}, length({c}) - {len(p)})')}" for p in affixes) + f" else {c} end"


_MARKS = "[''`’ʼʹ′´]"


def city_steps(c: str, source: str, carry: str) -> str:
    """A query with ``carry`` and the cleaned city as out, from a source with column c."""
    paren = r"\s*\([^)]*\)\s*$"
    return f"""(select {carry}, {trim(f"regexp_replace(c3, '{_MARKS}+$', '')")} as out from
      (select *, {strip_suffix("c2", fixed.CITY_SUFFIXES, 2)} as c3 from
      (select *, {strip_prefix("c1", fixed.CITY_PREFIXES)} as c2 from
      (select *, {trim(f"regexp_replace({repair(c)}, '{paren}', '')")} as c1 from {source}))))"""


def state_steps(c: str, source: str, carry: str) -> str:
    return f"""(select {carry}, {trim(f"regexp_replace(c5, '{_MARKS}+$', '')")} as out from
      (select *, regexp_replace(c4, '\\boblast{_MARKS}\\s*$', 'Oblast', 'i') as c5 from
      (select *, regexp_replace(c3, '\\s*voblasts{_MARKS}?\\s*$', ' Voblast', 'i') as c4 from
      (select *, {strip_suffix("c2", fixed.STATE_SUFFIXES)} as c3 from
      (select *, {strip_prefix("c1", fixed.STATE_PREFIXES)} as c2 from
      (select *, {repair(c)} as c1 from {source}))))))"""


def levenshtein_norm(a, b):
    n = f"greatest(length({a}), length({b}))"
    return f"(case when {n} = 0 then 100 else 100 - (100 * levenshtein({a}, {b})) // {n} end)"


def haversine_a(lat1, lon1, lat2, lon2):
    s = lambda x, y: f"sin((radians({y}) - radians({x})) / 2)"
    return f"({s(lat1, lat2)} * {s(lat1, lat2)} + cos(radians({lat1})) * cos(radians({lat2})) * {s(lon1, lon2)} * {s(lon1, lon2)})"


def haversine(lat1, lon1, lat2, lon2):
    a = haversine_a(lat1, lon1, lat2, lon2)
    return f"(6371.0 * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def box(country, lat, lon):
    out = ""
    for c, (s, n, w, e) in fixed.BOXES.items():
        lons = f"({lon} >= {w} or {lon} <= {e})" if w > e else f"({lon} >= {w} and {lon} <= {e})"
        out += f" when {country} = '{c}' then {lat} >= {s} and {lat} <= {n} and {lons}"
    return f"(case{out} else true end)"


def centroid(country, lat, lon):
    out = ""
    for c, points in fixed.CENTROIDS.items():
        near = " or ".join(f"(abs({lat} - {y}) < 0.05 and abs({lon} - {x}) < 0.05)" for y, x in points)
        out += f" when {country} = '{c}' then {near}"
    return f"(case{out} else false end)"


def island(lat, lon):
    return f"(abs({lat}) < 0.01 and abs({lon}) < 0.01)"


def outside(lat, lon):
    return f"({lat} < -90 or {lat} > 90 or {lon} < -180 or {lon} > 180)"


def address(a):
    octet = lambda s: f"cast(({a} >> {s}) & 255 as varchar)"
    return "(" + " || '.' || ".join(octet(s) for s in (24, 16, 8, 0)) + ")"


def cover(source: str, carry: str) -> str:
    """Blocks (addr, bits) of ranges [ip_start, ip_end] of a source."""
    return f"""(select {carry}, unnest(list_concat(
        case when l < r and l % 2 = 1 then [{{'addr': l * n, 'bits': 32 - k}}] else [] end,
        case when l + l % 2 < r and r % 2 = 1 then [{{'addr': (r - 1) * n, 'bits': 32 - k}}] else [] end), recursive := true)
      from (select *, (ip_start + n - 1) // n as l, (ip_end + 1) // n as r
            from (select *, cast(power(2, k) as bigint) as n from {source}, (select unnest(generate_series(0, 32)) as k))
            where ip_start <= ip_end))"""
