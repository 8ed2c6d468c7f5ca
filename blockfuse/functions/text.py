"""Names, postal codes and their repair, as expressions. Absent values are '' and stay ''."""

from __future__ import annotations

import re
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

#: Blanks of any script (Java's \s is ASCII only).
_WS = r"\s\x0B\x{85}\p{Z}"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim(c) -> Column:
    return F.regexp_replace(F.regexp_replace(_col(c), f"^[{_WS}]+", ""), rf"[{_WS}]+\z", "")


def lenient_float(c) -> Column:
    """A number, or 0 where the text is none (surrounding blanks and type suffixes make it none)."""
    c = F.coalesce(_col(c), F.lit(""))
    bad = c.rlike(rf"[{_WS}]") | c.rlike(r"^[+-]?[0-9.].*[fFdDlLsSyY]$") | (c == "")
    return F.when(bad, F.lit(0.0)).otherwise(F.coalesce(c.try_cast("double"), F.lit(0.0)))


def scrub(c) -> Column:
    """Trimmed; '' for placeholders."""
    t = trim(c)
    low = F.lower(t)
    hit = reduce(lambda a, p: a | low.contains(p), fixed.PLACEHOLDER_PARTS, low.isin(*fixed.PLACEHOLDERS))
    return F.when(hit, "").otherwise(t)


def scrub_postal(c) -> Column:
    s = scrub(c)
    return F.when(s.rlike("^[0 -]*$"), "").otherwise(s)


def normalize_postal(c) -> Column:
    return F.regexp_replace(F.upper(trim(c)), "[ -]", "")


#: Latin letters lose their marks; Cyrillic ё becomes Cyrillic е.
_FOLD = str.maketrans("äáàâãöóòôõüúùûéèêëíìîïñç\u0451", "aaaaaooooouuuueeeeiiiinc\u0435")


def normalize_name(c) -> Column:
    """Lower case without common diacritics and punctuation; 'saint' variants as 'st '."""
    s = F.lower(trim(c))
    s = F.translate(s, "".join(map(chr, _FOLD)), "".join(map(chr, _FOLD.values())))
    s = F.replace(s, F.lit("ß"), F.lit("ss"))
    saints = "|".join(p.replace(".", r"\.") for p in fixed.SAINTS)
    s = F.regexp_replace(s, f"^(?:{saints})", "st ")
    s = F.regexp_replace(s, rf"[^\p{{L}}\p{{Nd}}{_WS}_-]", "")
    return F.trim(F.regexp_replace(s, rf"[{_WS}_-]+", " "))


def contains_cyrillic(c) -> Column:
    return _col(c).rlike(r"[\x{0400}-\x{04FF}]")


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def known_latin(c) -> Column:
    """The Latin name of a known Cyrillic city; null if unknown."""
    return F.try_element_at(_map(fixed.CITIES), _col(c))


def known_cyrillic(c) -> Column:
    """The Cyrillic name of a known Latin city (the first in the order of the list); null if unknown."""
    back: dict[str, str] = {}
    for cyrillic, latin in fixed.CITIES.items():
        back.setdefault(latin, cyrillic)
    return F.try_element_at(_map(back), _col(c))


def transliterate(c) -> Column:
    """Cyrillic letters of either case as lower-case Latin ones; everything else as it is."""
    both = {**fixed.CYRILLIC_LETTERS, **{k.upper(): v for k, v in fixed.CYRILLIC_LETTERS.items()}}
    out = _col(c)
    for letter, latin in both.items():
        if len(latin) > 1:
            out = F.replace(out, F.lit(letter), F.lit(latin))
    single = {k: v for k, v in both.items() if len(v) == 1}
    gone = [k for k, v in both.items() if not v]
    return F.translate(out, "".join([*single, *gone]), "".join(single.values()))


def misread(c: str) -> str:
    """How a character's UTF-8 bytes look when they are read as Windows-1252."""
    out = []
    for b in c.encode():
        try:
            out.append(bytes([b]).decode("cp1252"))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


def mojibake_pairs() -> list[tuple[str, str]]:
    pairs = [(misread(bad), good) for bad, good in fixed.MISREAD_PUNCTUATION.items()]
    # the second byte of 'à' is a no-break space, which is met as a plain one
    return pairs + [("Ã " if c == "à" else misread(c), c) for c in fixed.MISREAD_LETTERS]


def repair_mojibake(c) -> Column:
    c = _col(c)
    fixed_ = reduce(lambda s, p: F.replace(s, F.lit(p[0]), F.lit(p[1])), mojibake_pairs(), c)
    return F.when(c.rlike("[Ãâ]"), fixed_).otherwise(c)


def has_artifact(c) -> Column:
    c = _col(c)
    hit = reduce(lambda a, p: a | c.contains(p), fixed.ARTIFACTS[1:], c.contains(fixed.ARTIFACTS[0]))
    return reduce(lambda a, p: a | F.lower(c).contains(p), fixed.ARTIFACTS_LOWER, hit)


def _any(affixes) -> str:
    return "(?:" + "|".join(re.escape(p) for p in affixes) + ")"


def _strip_prefix(c: Column, affixes) -> Column:
    """The first affix that fits goes, and what is left is trimmed; without one nothing changes."""
    return F.regexp_replace(c, rf"(?s)\A{_any(affixes)}[{_WS}]*(.*?)[{_WS}]*\z", "$1")


#: At least three bytes of UTF-8.
_THREE_BYTES = r"(?:.{3,}|.[^\x00-\x7F]|[^\x00-\x7F].|[\x{0800}-\x{10FFFF}])"


def _strip_suffix(c: Column, affixes, left: str = "") -> Column:
    """As for prefixes, at the end; ``left``: a pattern for what must stand before the affix."""
    ahead = rf"(?={left}{_any(affixes)}\z)" if left else ""
    return F.regexp_replace(c, rf"(?s)\A{ahead}[{_WS}]*(.*?)[{_WS}]*{_any(affixes)}\z", "$1")


_MARKS = "['`’ʼʹ′´]"


def clean_city(c) -> Column:
    s = repair_mojibake(c)
    s = trim(F.regexp_replace(s, r"\s*\([^)]*\)\s*\z", ""))
    s = _strip_suffix(_strip_prefix(s, fixed.CITY_PREFIXES), fixed.CITY_SUFFIXES, _THREE_BYTES)
    return trim(F.regexp_replace(s, _MARKS + r"+\z", ""))


def clean_state(c) -> Column:
    s = repair_mojibake(c)
    s = _strip_suffix(_strip_prefix(s, fixed.STATE_PREFIXES), fixed.STATE_SUFFIXES)
    s = F.regexp_replace(s, rf"(?i)\s*voblasts{_MARKS}?\s*\z", " Voblast")
    s = F.regexp_replace(s, rf"(?i)\boblast{_MARKS}\s*\z", "Oblast")
    return trim(F.regexp_replace(s, _MARKS + r"+\z", ""))


def dedupe_state_city(state, city) -> tuple[Column, Column]:
    """Both cleaned; the state is dropped where it equals the city but for case."""
    s, c = clean_state(state), clean_city(city)
    same = (s != "") & (c != "") & (F.lower(s) == F.lower(c))
    return F.when(same, "").otherwise(s), c


def levenshtein_norm(a, b) -> Column:
    """0 to 100: 100 - (100 * distance) div longest, over code points."""
    a, b = _col(a), _col(b)
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 100).otherwise(
        (100 - F.floor(100 * F.levenshtein(a, b) / F.when(longest == 0, 1).otherwise(longest))).cast("int")
    )


def byte_prefix(c, n: int) -> Column:
    return F.substring(F.encode(_col(c), "UTF-8"), 1, n)
