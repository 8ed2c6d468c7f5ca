"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: then up to ``?``, ``#``
or the end. Null, or no ``://``: both empty. A rule (host, path prefix, verdict) fits its host and all
its subdomains if the path begins with the rule's; the longest fitting rule wins.

The trees (Spark ML's GBTClassifier, a DataFrame estimator) are trained on labelled URLs: those
which a rule decides, or a table of (url, label). Features: length, depth, digit ratio, character
entropy, numbers of parameters, of hyphens and of host labels, length of the host, of its longest label
and of the last path segment, and for the host's last one and two labels the logarithm of their rows
and their smoothed share of blocked rows. Shares leave out the row's own label, so that training sees
what scoring sees. Statistics are grouped aggregations over all rows and joined by key; the trees are
fitted on at most ``SAMPLE`` distinct labelled URLs, those of the least hashes, weighted by their rows.

Defined cases: without labelled rows of both kinds, what no rule decides gets the only label (allow if
there is none). Repeated rows get equal verdicts. Extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: (host, path prefix, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
SAMPLE = 20_000
TREES, DEPTH, STEP = 20, 4, 0.2
SMOOTH = 10.0
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-._~/%?&=:#+"
FEATURES = (
    "f_length f_depth f_digits f_entropy f_params f_hyphens f_labels f_host f_longest f_last "
    "f_rows1 f_share1 f_rows2 f_share2"
).split()


def split_url(url) -> tuple[F.Column, F.Column]:
    """(host, path) of a URL column."""
    rest = F.when(url.contains("://"), F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"(?s)^([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def _fits(host, path, rule) -> F.Column:
    h, p, _ = rule
    return ((host == h) | host.endswith("." + h)) & path.startswith(p)


def decide(host, path, rules=RULES) -> tuple[F.Column, F.Column]:
    """(rule, verdict), null where no rule fits."""
    ordered = sorted(rules, key=lambda r: len(r[0]) + len(r[1]))  # the longest is asked first
    pick = lambda value: reduce(lambda rest, r: F.when(_fits(host, path, r), F.lit(value(r))).otherwise(rest), ordered, F.lit(None).cast("string"))
    return pick(lambda r: r[0] + r[1]), pick(lambda r: r[2])


def _lexical(df: DataFrame) -> DataFrame:
    """Features of the URL's text alone."""
    url = F.coalesce(F.col("url"), F.lit(""))
    low = F.lower(url)
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    count = lambda text, c: (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))).cast("double")
    parts = F.array(*[count(low, c) for c in _ALPHABET])
    rest = n - F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    gain = lambda x: F.when(x > 0, x / n * F.log2(n / x)).otherwise(F.lit(0.0))
    entropy = F.aggregate(F.concat(parts, F.array(rest)), F.lit(0.0), lambda a, x: a + gain(x))
    labels = F.split("host", r"\.")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return df.select(
        "*",
        n.alias("f_length"),
        count(F.col("path"), "/").alias("f_depth"),
        (F.length(F.regexp_replace(url, "[^0-9]", "")) / n).alias("f_digits"),
        entropy.alias("f_entropy"),
        F.when(query == "", 0.0).otherwise(count(query, "&") + 1).alias("f_params"),
        count(low, "-").alias("f_hyphens"),
        F.size(labels).cast("double").alias("f_labels"),
        F.length("host").cast("double").alias("f_host"),
        F.array_max(F.transform(labels, F.length)).cast("double").alias("f_longest"),
        F.length(F.regexp_extract("path", r"([^/]*)/?$", 1)).cast("double").alias("f_last"),
        F.substring_index("host", ".", -1).alias("suffix1"),
        F.substring_index("host", ".", -2).alias("suffix2"),
    )


def features(labelled: DataFrame) -> DataFrame:
    """Rows (url, host, path, label or null, ...) with FEATURES."""
    rows = materialize(_lexical(labelled), "urls")
    known, bad = F.count("label"), F.coalesce(F.sum("label"), F.lit(0.0))
    # the two-label table has the one-label sums in it: hot suffixes are aggregated before any shuffle
    two = rows.groupBy("suffix2", "suffix1").agg(F.count("*").alias("r2"), known.alias("k2"), bad.alias("b2"))
    two = materialize(two, "suffixes")
    one = two.groupBy("suffix1").agg(F.sum("r2").alias("r1"), F.sum("k2").alias("k1"), F.sum("b2").alias("b1"))
    whole = one.agg(F.sum("k1"), F.sum("b1")).first()
    mean = (whole[1] or 0.0) / whole[0] if whole[0] else 0.0
    own, mine = F.col("label").isNotNull().cast("double"), F.coalesce("label", F.lit(0.0))
    joined = rows.join(two.drop("suffix1"), "suffix2", "left").join(one, "suffix1", "left")
    share1 = (F.col("b1") - mine + SMOOTH * mean) / (F.col("k1") - own + SMOOTH)
    share2 = (F.col("b2") - mine + SMOOTH * F.col("f_share1")) / (F.col("k2") - own + SMOOTH)
    return (
        joined.withColumn("f_share1", share1)
        .withColumn("f_share2", share2)
        .withColumn("f_rows1", F.log1p("r1"))
        .withColumn("f_rows2", F.log1p("r2"))
    )


def train(rows: DataFrame, sample: int = SAMPLE):
    """The trees, or the only label there is (0.0 without any), from rows with FEATURES and label."""
    known = rows.where("label is not null")
    n, low, high = known.agg(F.count("*"), F.min("label"), F.max("label")).first()
    if not n or low == high:
        return low or 0.0
    if n > sample:  # the distinct URLs of the least hashes, each with the number of its rows as weight
        hashed = known.withColumn("h", F.xxhash64("url"))
        chosen = hashed.groupBy("h").agg(F.count("*").cast("double").alias("w")).orderBy("h").limit(sample)
        known = hashed.join(F.broadcast(materialize(chosen, "chosen")), "h").dropDuplicates(["h"])
    else:
        known = known.withColumn("w", F.lit(1.0))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(known.select("label", "w", *FEATURES))
    return GBTClassifier(weightCol="w", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7, maxBins=32).fit(vectors)


def classify(
    pages: DataFrame, page_id: str = "page_id", url_col: str = "url", rules=RULES, labels: DataFrame | None = None
) -> DataFrame:
    """One row per page: page_id, url, host, path, rule, verdict, block_score (null where a rule decides).

    ``labels``: rows (url, label: 1 block, 0 allow); without it the rules' own verdicts are learned."""
    url = F.col(url_col).cast("string")
    host, path = split_url(F.col("url"))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), url.alias("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rule, verdict = decide(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("ruled", verdict)
    if labels is None:
        rows = rows.withColumn("label", F.when(F.col("ruled").isNotNull(), (F.col("ruled") == "block").cast("double")))
    else:
        given = labels.groupBy(F.col("url").cast("string").alias("url")).agg(F.max(F.col("label").cast("double")).alias("label"))
        rows = rows.join(given, "url", "left")
    ready = features(rows)
    model = train(ready)
    if isinstance(model, float):
        scored = ready.withColumn("score", F.lit(model))
    else:
        model.setFeaturesCol("features").setPredictionCol("said").setProbabilityCol("p").setRawPredictionCol("raw")
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(ready))
        scored = scored.withColumn("score", F.col("said"))
    free = F.col("ruled").isNull()
    return scored.select(
        "page_id",
        "url",
        "host",
        "path",
        "rule",
        F.when(~free, F.col("ruled")).when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
        F.when(free, F.col("score")).alias("block_score"),
    )
