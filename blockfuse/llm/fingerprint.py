"""I-Match fingerprints: terms of middling document frequency, over randomised lexicon subsets.

Lexicon: the terms whose document frequency, over all documents, lies within [``LOW``, ``HIGH``] times the
number of documents (that is an inverse-document-frequency band). Each document adds its distinct terms to
the sum of frequencies, so there are at most ``mean distinct terms / LOW`` of them, however large the corpus.
All of them are kept.

Each of ``LEVELS`` x ``PER_LEVEL`` random subsets of the lexicon gives one signature of a document: a hash of
the set of its terms that lie in the subset (the exclusive or of the terms' 64-bit hashes, which needs
no order). The subsets of a level take one term in RATES[level] each, so that short
and long texts alike have levels at which a moderate edit leaves some signatures as they were. The
fingerprint is the sequence of signatures (8 hex digits each; '-' where no term lies in the subset),
and its last part, a hash of all terms of the text, tells apart texts without lexicon terms.

Likeness of two fingerprints: the share of equal signatures among the subsets in which either has
terms; for two documents without any, 1 if the hashes of all their terms agree, else 0.

Everything is DataFrame operations. Membership in the lexicon is exact: the distinct terms of the texts, one row
each, are joined with the lexicon, which is broadcast up to ``LEXICON_BYTES`` and shuffled beyond.

Defined cases: null and empty texts are ''; their fingerprint is the same for all. Equal texts have
equal fingerprints. Rows of equal id are put in order by text; rows without id come last, by a hash of
the text. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small

LOW, HIGH = 0.0005, 0.1
RATES, PER_LEVEL = (4, 16, 64, 256), 12
#: A larger lexicon (of 40 bytes a term) is not broadcast.
LEXICON_BYTES = 32 << 20

#: Terms: runs of letters, digits and anything beyond ASCII, in lower case.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text) -> F.Column:
    """Distinct terms of a text, as 64-bit hashes."""
    words = F.split(F.lower(text), _GAP)
    return F.array_remove(F.transform(F.array_distinct(words), lambda w: F.xxhash64(w)), F.xxhash64(F.lit("")))


def _drawn(rate: int, salt: int) -> F.Column:
    """Whether a random subset of the lexicon holds the term."""
    return F.pmod(F.xxhash64("term", F.lit(salt)), F.lit(rate)) == 0


def band(term_arrays: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Hashes (column term) of the terms within the band, of rows (terms)."""
    n = term_arrays.count()
    counts = term_arrays.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return counts.where((F.col("df") >= max(2, low * n)) & (F.col("df") <= max(2, high * n))).select("term")


def lexicon(term_arrays: DataFrame, low: float = LOW, high: float = HIGH) -> list[int]:
    """The band's hashes as a list (to look at; the operators keep them in a table)."""
    return [r[0] for r in band(term_arrays, low, high).collect()]


def members(term_arrays: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """The lexicon as a work table: term, and as bits of ``subsets`` the random subsets that hold it."""
    bits = [F.when(_drawn(rate, k * PER_LEVEL + j), F.lit(1 << (k * PER_LEVEL + j))).otherwise(F.lit(0)).cast("long") for k, rate in enumerate(RATES) for j in range(PER_LEVEL)]
    held = materialize(band(term_arrays, low, high), "lexicon")
    subsets = F.aggregate(F.array(*bits), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return materialize(held.select(F.col("term").alias("member"), subsets.alias("subsets")), "subsets")


def signatures() -> list[F.Column]:
    """Aggregates over a text's rows (term, subsets): the hash of its terms in each subset, 0 without any."""
    drawn = lambda j: F.col("subsets").bitwiseAND(F.lit(1 << j).cast("long")) != 0
    return [F.bit_xor(F.when(drawn(j), F.col("term")).otherwise(F.lit(0).cast("long"))).alias(f"__s{j}") for j in range(len(RATES) * PER_LEVEL)]


def render(whole) -> F.Column:
    sig = [F.when(F.col(f"__s{j}") == 0, "-").otherwise(F.substring(F.hex(f"__s{j}"), -8, 8)) for j in range(len(RATES) * PER_LEVEL)]
    return F.concat(F.concat_ws(".", *sig), F.lit("/"), F.hex(whole))


def likeness(a, b) -> F.Column:
    """Of two rendered fingerprints, 0 to 1."""
    pairs = F.arrays_zip(F.split(F.substring_index(a, "/", 1), r"\.").alias("x"), F.split(F.substring_index(b, "/", 1), r"\.").alias("y"))
    used = F.filter(pairs, lambda p: (p["x"] != "-") | (p["y"] != "-"))
    same = F.size(F.filter(used, lambda p: p["x"] == p["y"]))
    whole = (F.substring_index(a, "/", -1) == F.substring_index(b, "/", -1)).cast("double")
    return F.when(F.size(used) > 0, same / F.size(used)).otherwise(whole)


#: Bytes of text in a range of ids on average, and most ranges.
RANGE_BYTES, MOST_RANGES = 64 << 20, 4096


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows (part, id, text) with next_text: the text of the next row in descending order of id (rows of equal id
    by text); rows without id follow, in order of a hash of the text; after the last comes the first.

    Rows are cut by quantiles of the id into ranges, as many as the texts' bytes ask for (rows without id by
    their hash); each range's first row is also sent to the range before it, so that a window within the
    ranges finds every next row."""
    size = lambda none: F.coalesce(F.sum(F.when(F.col("id").isNull() == F.lit(none), F.octet_length("text"))), F.lit(0))
    named, unnamed = docs.agg(size(False), size(True)).first()
    parts = min(MOST_RANGES, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), named // range_bytes))
    spread = min(MOST_RANGES, 1 + unnamed // range_bytes)
    cuts = docs.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 4 * parts)).first()[0] if parts > 1 else []
    cuts = sorted(set(cuts or []))
    # range 0 holds the largest ids; rows without id come behind, by their hash
    by_id = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<long>"), lambda c: c >= F.col("id")))
    by_hash = len(cuts) + 1 + F.floor((F.xxhash64("text").cast("double") / float(1 << 64) + 0.5) * spread)
    by_hash = F.least(by_hash, F.lit(len(cuts) + spread))
    ranged = docs.withColumn("part", F.when(F.col("id").isNull(), by_hash).otherwise(by_id).cast("int"))
    ranged = ranged.withColumn("k", F.when(F.col("id").isNull(), -F.xxhash64("text").cast("decimal(20,0)")).otherwise(F.col("id").cast("decimal(20,0)")))
    first = ranged.groupBy("part").agg(F.max("k").alias("k")).withColumnRenamed("part", "p")
    firsts = ranged.join(F.broadcast(first.select(F.col("p").alias("fp"), F.col("k").alias("fk"))), (F.col("part") == F.col("fp")) & (F.col("k") == F.col("fk")), "left_semi")
    firsts = firsts.groupBy("part").agg(F.max("k").alias("k"), F.min("text").alias("text"))
    order = Window.orderBy("part")  # one row a range
    sent = firsts.select(
        F.coalesce(F.lag("part").over(order), F.max("part").over(Window.partitionBy(F.lit(1)))).alias("part"), "k", "text"
    )
    rows = ranged.select("part", "id", "k", "text", F.lit(0).alias("sent")).unionByName(
        sent.select("part", F.lit(None).cast("long").alias("id"), "k", "text", F.lit(1).alias("sent"))
    )
    by = Window.partitionBy("part").orderBy("sent", F.col("k").desc(), "text")
    return rows.withColumn("next_text", F.lead("text").over(by)).where("sent = 0").select("part", "id", "text", "next_text")


def _printed(rows: DataFrame, texts: dict[str, str], lex: DataFrame) -> DataFrame:
    """``rows`` with the fingerprints of text columns ({text column: fingerprint column}) in place of the texts.

    All columns but the terms are keys of the aggregation, so rows that are partitioned by one of them
    are not shuffled again where the lexicon is broadcast."""
    keys = [c for c in rows.columns if c not in texts] + ["__row"]
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    one = rows.select(*keys, F.posexplode(F.array(*[terms(F.col(t)) for t in texts])).alias("__which", "__t"))
    # a step of its own, as beside the generator it would be computed for every term
    one = one.select(*keys, "__which", F.xxhash64(F.array_sort("__t")).alias("__whole"), "__t")
    one = one.select(*keys, "__which", "__whole", F.explode_outer("__t").alias("term"))
    lex = F.broadcast(lex) if small(lex, 40, LEXICON_BYTES) else lex
    one = one.join(lex, F.col("term") == F.col("member"), "left")
    one = one.groupBy(*keys, "__which", "__whole").agg(*signatures())
    one = one.select(*keys, "__which", render(F.col("__whole")).alias("__fp"))
    found = [F.max(F.when(F.col("__which") == i, F.col("__fp"))).alias(out) for i, out in enumerate(texts.values())]
    return one.groupBy(*keys).agg(*found).drop("__row")


def _clean(docs: DataFrame, doc_id: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("id"), text.alias("text"))


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH
) -> DataFrame:
    """One row per document: doc_id, fingerprint."""
    rows = _clean(docs, doc_id, text_col)
    lex = members(rows.select(terms(F.col("text")).alias("terms")), low, high)
    return _printed(rows, {"text": "fingerprint"}, lex).select(F.col("id").alias("doc_id"), "fingerprint")


def edited_study(
    docs: DataFrame, doc_id: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH
) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last third replaced by the beginning of the
    next document's text), and how alike they are: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    rows = _clean(docs, doc_id, text_col)
    lex = members(rows.select(terms(F.col("text")).alias("terms")), low, high)
    paired = with_next(rows)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    paired = paired.select("part", "id", n.cast("long").alias("n_chars"), "text", "next_text", edited.alias("edited"))
    paired = paired.withColumn("edited_sha256", F.sha2("edited", 256))
    out = _printed(paired, {"text": "fingerprint", "next_text": "next_fp", "edited": "edited_fingerprint"}, lex)
    return out.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fp")).alias("near_next"),
    )
