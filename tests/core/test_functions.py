import ipaddress
import math
import random

from pyspark.sql import functions as F

from blockfuse.functions import fixed, geo, ip, text


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_every_city_affix_goes_once(spark):
    """From the rules: one prefix, then one suffix, what is left trimmed; suffixes need three bytes before them."""
    cases = {p + "Brackwede": "Brackwede" for p in fixed.CITY_PREFIXES} | {"Oldenzaal" + x: "Oldenzaal" for x in fixed.CITY_SUFFIXES}
    cases |= {p + p + "Ulm": (p + "Ulm").strip() for p in fixed.CITY_PREFIXES[:4]}
    cases |= {"ab" + x: "ab" + x for x in fixed.CITY_SUFFIXES} | {"éa" + x: "éa" for x in fixed.CITY_SUFFIXES}
    cases |= {f"Leer{q * 2}": "Leer" for q in fixed.SOFT_SIGNS if q != "’"} | {"Hof (am See) ": "Hof", "Hof (a) b": "Hof (a) b", "\u00a0Aue\t": "Aue"}
    assert dict(zip(cases, column(spark, list(cases), text.clean_city), strict=True)) == cases


def test_every_state_affix_goes_once(spark):
    cases = {p + "Drenthe": "Drenthe" for p in fixed.STATE_PREFIXES} | {"Drenthe" + x: "Drenthe" for x in fixed.STATE_SUFFIXES}
    cases |= {f"Tomskaya oblast{q}": "Tomskaya Oblast" for q in fixed.SOFT_SIGNS if q != "’"} | {"Tomskaya OBLAST'  ": "Tomskaya Oblast", "Tomskaya oblast": "Tomskaya oblast"}
    cases |= {"Brestskaya voblasts": "Brestskaya Voblast", "Brestskaya VOBLASTS' ": "Brestskaya Voblast", "Regional Park": "Regional Park"}
    assert dict(zip(cases, column(spark, list(cases), text.clean_state), strict=True)) == cases


def test_repair_undoes_every_misreading(spark):
    """Text in UTF-8 that was read as Windows-1252 comes back, for each pair of the table (of 'à', whose second byte
    is a no-break space, with a plain one); other text stays."""
    letters = {text.misread(c).replace("\u00a0", " "): c for c in fixed.MISREAD_LETTERS} | {text.misread(c): v for c, v in fixed.MISREAD_PUNCTUATION.items()}
    cases = {f"x{bad}y": f"x{good}y" for bad, good in letters.items()} | {"Zürich": "Zürich", "": ""}
    assert dict(zip(cases, column(spark, list(cases), text.repair_mojibake), strict=True)) == cases
    assert len(text.mojibake_pairs()) == len(letters)
    flags = {f"a{x}b": True for x in fixed.ARTIFACTS} | {f"Q {x.upper()}": True for x in fixed.ARTIFACTS_LOWER} | {"Zürich": False, "oblast": False, "": False}
    assert dict(zip(flags, column(spark, list(flags), text.has_artifact), strict=True)) == flags


def test_dedupe_state_city(spark):
    cases = [("Zug", "ZUG City", "", "ZUG"), ("Zug Region", "Zug (Altstadt)", "", "Zug"), ("Uri", "Zug", "Uri", "Zug"), ("", "Zug", "", "Zug"), ("Uri", "", "Uri", ""), ("", "", "", "")]
    df = spark.createDataFrame([c[:2] for c in cases], "s string, c string")
    got = df.select(*text.dedupe_state_city("s", "c")).collect()
    assert [tuple(r) for r in got] == [c[2:] for c in cases]


def test_names(spark):
    cases = {
        "Saint-Petersburg": "st petersburg", "St. Petersburg": "st petersburg", "  MÜNCHEN ": "munchen", "Łódź": "łódź".replace("ó", "o"),
        "a--b__c  d": "a b c d", "Straße": "strasse", "орёл": "орел", "x　y": "x y", "O'Fallon!": "ofallon", "": "", "- a -": "a",
    }
    assert dict(zip(cases, column(spark, list(cases), text.normalize_name), strict=True)) == cases
    assert column(spark, ["SW1A 1AA", " 10-115 ", "ab"], text.normalize_postal) == ["SW1A1AA", "10115", "AB"]
    assert column(spark, ["Щёлково", "Ўкраїна z", "объём"], text.transliterate) == ["shchelkovo", "wkrayina z", "obem"]
    assert column(spark, ["st petersburg", "none"], text.known_cyrillic) == ["санкт петербург", None]
    assert len(fixed.CITIES) == 138


def test_scrub_and_floats(spark):
    assert column(spark, [" N/A ", "x", "Parameter unavailable.", " y ", "none"], text.scrub) == ["", "x", "", "y", ""]
    assert column(spark, ["0000", "0 -", "010", "-"], text.scrub_postal) == ["", "", "010", ""]
    got = column(spark, ["55.7", " 55.7", "1.5f", "", "abc", "-3", "1e3", None], text.lenient_float)
    assert got == [55.7, 0.0, 0.0, 0.0, 0.0, -3.0, 1000.0, 0.0]


def test_levenshtein(spark):
    df = spark.createDataFrame([("москва", "moskva"), ("kitten", "sitting"), ("", ""), ("a", "")], "a string, b string")
    assert [r[0] for r in df.select(text.levenshtein_norm("a", "b")).collect()] == [0, 58, 100, 0]


def test_round_coord(spark):
    """Five digits, halves away from zero; what is no number is 0."""
    rnd = random.Random(12)
    values = [rnd.uniform(-180, 180) for _ in range(200)] + [0.5e-5, -0.5e-5, 0.25, -0.0]
    want = [math.copysign(math.floor(abs(v * 100000) + 0.5) / 100000, v) for v in values]
    odd = [float("nan"), float("inf"), float("-inf")]
    assert column(spark, values + odd, geo.round_coord, "double") == want + [0.0] * 3


def test_coordinates(spark):
    rows = [("RU", 60.0, 179.0), ("RU", 60.0, 0.0), ("DE", 51.01, 9.04), ("DE", 51.06, 9.0), ("XX", 0.0, 0.0), ("US", math.nan, 1.0)]
    df = spark.createDataFrame(rows, "c string, y double, x double")
    c, y, x = F.col("c"), F.col("y"), F.col("x")
    got = df.select(geo.in_country_box(c, y, x), geo.is_country_centroid(c, y, x), geo.null_island(y, x), geo.out_of_range(y, x))
    assert [tuple(r) for r in got.collect()] == [
        (True, False, False, False), (False, False, False, False), (True, True, False, False), (True, False, False, False),
        (True, False, True, False), (False, False, False, False),
    ]


def test_addresses(spark):
    texts = ["0.0.0.0", "255.255.255.255", "1.2.3.4", "256.1.1.1", "1.2.3", "01.2.3.4", "1.2.3.4 ", "::1"]
    assert column(spark, texts, ip.to_int) == [0, (1 << 32) - 1, 16909060, None, None, None, None, None]
    assert column(spark, [0, 16909060, (1 << 32) - 1], ip.to_text, "long") == ["0.0.0.0", "1.2.3.4", "255.255.255.255"]


def test_cover_equals_the_standard_library(spark):
    rnd = random.Random(1)
    ranges = [(0, (1 << 32) - 1), (5, 5), (7, 3), (0, 0)]
    for _ in range(300):
        a = rnd.randrange(1 << rnd.randint(1, 32))
        ranges.append((a, min((1 << 32) - 1, a + rnd.randrange(1 << rnd.randint(1, 31)))))
    df = spark.createDataFrame(ranges, "a long, b long")
    for (a, b), (got,) in zip(ranges, df.select(ip.cover("a", "b")).collect(), strict=True):
        want = []
        if a <= b:
            want = [
                (int(n.network_address), n.prefixlen)
                for n in ipaddress.summarize_address_range(ipaddress.IPv4Address(a), ipaddress.IPv4Address(b))
            ]
        assert [(x.addr, x.bits) for x in got] == want


def test_split24(spark):
    df = spark.sql("select named_struct('addr', 65536L, 'bits', 22) b union all select named_struct('addr', 256L, 'bits', 25)")
    got = [[(x.addr, x.bits) for x in r[0]] for r in df.select(ip.split24("b")).collect()]
    assert got == [[(65536 + 256 * i, 24) for i in range(4)], [(256, 25)]]
