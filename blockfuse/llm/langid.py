"""Language identification by fusing four kinds of evidence.

For each row and language l the log posterior is

    TEXT * log P(text | l)  +  log P(declared | l)  +  log P(address suffix | l)  +  log P(l | host)

* P(text | l): byte-trigram model with add-one smoothing over ``CELLS`` hash cells, per trigram; fitted
  on a bounded sample of rows (at most ``SAMPLE`` by a hash of the text, whole texts) with their
  declared language. TEXT is a temper for the trigrams' dependence: a text counts as at most
  ``EVIDENCE`` independent trigrams.
* the declared language is the first subtag of what is declared ('en' of 'en-GB'), as a code of two letters
  where it has one;
* P(declared | l) and P(suffix | l): tables counted over all rows, with the text's own best language
  in the place of the true one, smoothed.
* P(l | host): the host's counts over all rows, smoothed towards its suffix's distribution, which is
  smoothed towards the distribution of all rows.

All counts come from grouped aggregations; the host table is joined by key, so that a host with a
third of all rows is split by adaptive execution. Besides the languages there is the hypothesis
``und`` under which every hash cell is equally likely and the other evidence is uninformative: noise.

A row is rejected (``accepted`` false, lang ``und``) if its text has no letter (null, empty, digits,
punctuation) or if ``und`` has the largest posterior. Missing declared language, suffix or host is a
value of its own, without weight. Ties go to the first language in code point order. Repeated rows get
equal results. Columns of the input named like an output column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, sampled, texts

LANGUAGES = ("de", "en", "es", "fr")
#: Codes of three letters for those of two.
CODES = {
    "deu": "de", "eng": "en", "fra": "fr", "fre": "fr", "ger": "de", "spa": "es",
}
SAMPLE = 2000
CELLS = 1 << 16
EVIDENCE = 60.0
SMOOTH = 20.0
NOISE = "und"

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_RAW = re.compile(rb"(?i)<(script|style)\b")
_CLOSE = {name: re.compile(rb"(?i)</" + name + rb"\s*>") for name in (b"script", b"style")}


def strip_markup(html: bytes | None) -> bytes:
    """The text between tags, without scripts, styles and comments. What is opened and never closed is read as a
    tag, up to the next '>'; without one the rest is text. One scan forward: what the rest of the page
    was found not to hold is not sought again."""
    html, out, at, lacking = html or b"", [], 0, set()

    def end(kind: bytes, first: int) -> int:
        if kind in lacking:
            return -1
        if kind in _CLOSE:
            m = _CLOSE[kind].search(html, first)
            stop = m.end() if m else -1
        else:
            found = html.find(kind, first)
            stop = found + len(kind) if found >= 0 else -1
        if stop < 0:
            lacking.add(kind)
        return stop

    while (first := html.find(b"<", at)) >= 0:
        stop, raw = -1, _RAW.match(html, first)
        if raw:
            stop = end(raw[1].lower(), raw.end())
        elif html.startswith(b"<!--", first):
            stop = end(b"-->", first + 4)
        if stop < 0:
            stop = end(b">", first + 1)
        if stop < 0:
            break
        out.append(html[at:first])
        at = stop
    out.append(html[at:])
    return b" ".join(out)


def cells(text: bytes | None) -> np.ndarray:
    """Hash cells of the byte trigrams of a text; anything but letters is one blank."""
    folded = b" ".join((text or b"").translate(_FOLD).split())
    if not folded:
        return np.empty(0, np.uint32)
    b = np.frombuffer(b" " + folded + b" ", np.uint8).astype(np.uint32)
    h = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (h * np.uint32(2654435761)) >> np.uint32(16)


def fit(sample: list[tuple[str, bytes]], languages=LANGUAGES) -> np.ndarray:
    """log P(cell | language), and at the end of noise: CELLS x (languages + 1)."""
    counts = np.ones((len(languages), CELLS))
    for lang, text in sample:
        if lang in languages:
            counts[languages.index(lang)] += np.bincount(cells(text), minlength=CELLS)
    out = np.log(counts / counts.sum(axis=1, keepdims=True))
    return np.vstack([out, np.full((1, CELLS), -np.log(CELLS))]).T.astype(np.float32).copy()


def _rows(df: DataFrame, text, declared, suffix, host) -> DataFrame:
    text, declared, suffix, host = (F.col(c) if isinstance(c, str) else c for c in (text, declared, suffix, host))
    first = lambda c: F.lower(F.regexp_extract(c.cast("string"), r"^\s*([A-Za-z]+)", 1))
    codes = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    clean = lambda c: F.coalesce(codes[first(c)], first(c), F.lit(""))
    return df.select(
        "*",
        text.cast("string").alias("__text"),
        clean(declared).alias("__declared"),
        F.coalesce(suffix.cast("string"), F.lit("")).alias("__suffix"),
        F.coalesce(host.cast("string"), F.lit("")).alias("__host"),
    )


def sample_texts(rows: DataFrame, languages, sample: int, markup: bool) -> list[tuple[str, bytes]]:
    """At most ``sample`` rows of a declared language, with distinct texts: those of the least text hashes."""
    usable = rows.where(F.col("__declared").isin(*languages) & (F.octet_length("__text") > 0))
    strip = strip_markup if markup else (lambda t: t)
    return [(r[0], strip(r[1].encode())) for r in sampled(usable.select("__declared", "__text"), "__text", sample)]


def identify(
    df: DataFrame,
    text,
    declared,
    suffix,
    host,
    markup: bool = False,
    languages: tuple[str, ...] = LANGUAGES,
    sample: int = SAMPLE,
    model: np.ndarray | None = None,
) -> DataFrame:
    """``df`` with lang_id, lang_posterior and accepted. ``text`` ... ``host``: columns; ``markup``: the text
    is HTML, of which only what stands between tags counts."""
    names = ("lang_id", "lang_posterior", "accepted")
    df = df.select(*[df[f"`{c}`"] for c in df.columns if c not in names])
    rows = _rows(df, text, declared, suffix, host)
    spark, width = df.sparkSession, len(languages) + 1
    if model is None:
        model = fit(sample_texts(rows, languages, sample, markup), languages)
    shipped = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped.value
        for batch in batches:
            likely, letters = [], []
            for t in texts(batch.column(batch.num_columns - 4)):
                at = cells(strip_markup(t) if markup else t)
                letters.append(len(at))
                if not len(at):
                    likely.append(np.zeros(width))
                elif len(at) <= CELLS:
                    likely.append(table[at].sum(axis=0, dtype=np.float64))
                else:
                    likely.append(np.bincount(at, minlength=CELLS) @ table.astype(np.float64))
            n = np.maximum(np.array(letters, np.float64), 1)[:, None]
            scores = np.stack(likely) * (np.minimum(n, EVIDENCE) / n) if likely else np.empty((0, width))
            flat = pa.array(scores.ravel(), pa.float64())
            offsets = pa.array(np.arange(len(letters) + 1) * width, pa.int32())
            columns = [c for k, c in enumerate(batch.columns) if k != batch.num_columns - 4]
            fields = [f for k, f in enumerate(batch.schema.names) if k != batch.num_columns - 4]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(offsets, flat), pa.array(letters, pa.int64())],
                [*fields, "__scores", "__letters"],
            )

    narrow = rows
    schema = T.StructType(
        [f for f in narrow.schema.fields if f.name != "__text"]
        + [T.StructField("__scores", T.ArrayType(T.DoubleType())), T.StructField("__letters", T.LongType())]
    )
    fields = [f for f in narrow.columns if f not in ("__text", "__declared", "__suffix", "__host")]
    narrow = narrow.select(*[F.col(f"`{c}`") for c in fields], "__text", "__declared", "__suffix", "__host")
    scored = materialize(narrow.mapInArrow(score, schema), "scores")

    # what the text alone says, for the counts
    langs = list(languages)
    of = lambda k: F.element_at("__scores", k + 1)
    best = F.array_max(F.slice("__scores", 1, len(langs)))
    map_lang = reduce(lambda rest, k: F.when(of(k) == best, F.lit(k)).otherwise(rest), reversed(range(len(langs))), F.lit(0))
    usable = scored.where((F.col("__letters") > 0) & (best > of(len(langs))))
    told = usable.select("__declared", "__suffix", "__host", map_lang.alias("m"))
    each = [F.count_if(F.col("m") == k).cast("double").alias(f"n{k}") for k in range(len(langs))]
    hosts = materialize(told.groupBy("__host", "__suffix", "__declared").agg(*each), "hosts")
    total = lambda df, *by: df.groupBy(*by).agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(len(langs))])
    alls = list(hosts.agg(*[F.sum(f"n{k}") for k in range(len(langs))]).first())
    alls = [x or 0.0 for x in alls]
    prior = [(x + 1) / (sum(alls) + len(langs)) for x in alls]

    def given(table: DataFrame, by: str, out: str) -> DataFrame:
        """log P(value | l), smoothed by the value's share in all rows."""
        table = total(table, by)
        n = sum((F.col(f"n{k}") for k in range(len(langs))), F.lit(0.0))
        share = (n + 1) / (sum(alls) + len(langs))
        cols = [F.log((F.col(f"n{k}") + SMOOTH * share) / (alls[k] + SMOOTH)) - F.log(share) for k in range(len(langs))]
        return table.select(by, F.when(F.col(by) == "", F.array(*[F.lit(0.0)] * len(langs))).otherwise(F.array(*cols)).alias(out))

    suffixes = total(hosts, "__suffix")
    n = sum((F.col(f"n{k}") for k in range(len(langs))), F.lit(0.0))
    suffix_prior = suffixes.select(
        "__suffix", F.array(*[(F.col(f"n{k}") + SMOOTH * prior[k]) / (n + SMOOTH) for k in range(len(langs))]).alias("sp")
    )
    host_prior = total(hosts, "__host", "__suffix").join(suffix_prior, "__suffix")
    host_prior = host_prior.select(
        "__host",
        "__suffix",
        F.array(*[F.log((F.col(f"n{k}") + SMOOTH * F.element_at("sp", k + 1)) / (n + SMOOTH)) for k in range(len(langs))]).alias("hp"),
    )
    zero = F.array(*[F.lit(0.0)] * len(langs))
    base = F.array(*[F.log(F.lit(p)) for p in prior])
    fused = (
        scored.join(given(hosts, "__declared", "dl"), "__declared", "left")
        .join(given(hosts, "__suffix", "sl"), "__suffix", "left")
        .join(host_prior, ["__host", "__suffix"], "left")
    )
    part = lambda c, k, other: F.element_at(F.coalesce(F.col(c), other), k + 1)
    logs = [of(k) + part("dl", k, zero) + part("sl", k, zero) + part("hp", k, base) for k in range(len(langs))]
    logs.append(of(len(langs)) + F.log(F.lit(1.0 / len(langs))))
    fused = fused.withColumn("__logs", F.array(*logs))
    top = F.array_max("__logs")
    sums = F.aggregate("__logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("__top")))
    fused = fused.withColumn("__top", top).withColumn("__sum", sums)
    pick = F.element_at(F.array(*[F.lit(x) for x in [*langs, NOISE]]), F.array_position("__logs", F.col("__top")).cast("int"))
    lang = F.when(F.col("__letters") > 0, pick).otherwise(F.lit(NOISE))
    keep = [F.col(f"`{c}`") for c in df.columns]
    return fused.select(
        *keep,
        lang.alias("lang_id"),
        F.when(F.col("__letters") > 0, 1.0 / F.col("__sum")).otherwise(F.lit(0.0)).alias("lang_posterior"),
        (lang != NOISE).alias("accepted"),
    )


#: Host and last label of a URL, and the language its page declares.
def url_host(url) -> F.Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.lower(host)


def url_suffix(url) -> F.Column:
    return F.regexp_extract(url_host(url), r"([^.:]+)(?::[0-9]*)?$", 1)


def declared_in(html) -> F.Column:
    return F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2,8})", 1)


def identify_pages(pages: DataFrame, **more) -> DataFrame:
    """Pages (url, html): text between the tags, the declared language, the address's suffix and host."""
    html, url = F.col("html").cast("string"), F.col("url").cast("string")
    return identify(pages, html, declared_in(html), url_suffix(url), url_host(url), markup=True, **more)


def identify_documents(docs: DataFrame, **more) -> DataFrame:
    """Documents (text, lang, source): the lang column is the declared language, the source the host."""
    return identify(docs, "text", "lang", F.lit(""), "source", **more)
