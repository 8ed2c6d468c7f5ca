"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every document enters the queue of its source up to ``most_times`` times (once per epoch), in an order
shuffled by a hash. Its virtual finish time is the source's words so far, itself included, divided by
the source's target. All virtual copies are ordered by finish time, over all sources, and the order is
truncated where the words reach the total budget: each source has then come about as far as any other.

Within a source and an epoch the copies that are taken are the first of its order. So the whole decision is a
table of one row a source: its size, its target and the last key that each epoch takes. The documents
meet that table, and no text is shuffled where it is small enough to be broadcast.

Running sums never gather a source in one task: a source's order is cut by the hash's first bytes
into buckets (as many as the rows ask for), whose sums give each bucket's start; the global order is cut
into slices of finish time, again and again within the slice in which the budget ends, until that
slice is small enough to be put in order.

Size: runs of ``[^\x20\x09-\x0D]`` in the text, 0 for null. Sources in code point order, null last, weigh
``WEIGHTS`` in turn (empty sources take their turn) and share ``share`` of all words by weight; no
target exceeds ``most_times`` times the source's size, the excess goes to the others by weight.

Defined cases: a document without words takes nothing; an empty table gives no rows; documents of
equal id (or without) are ordered by size, then by a hash of the text; equal rows share one place in the
order, and are taken together. Extra columns are ignored by ``mix`` and kept by ``mix_rows``, where those
named like an output column are replaced. Copies of equal finish time are taken together or not at
all, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, maybe_broadcast

WEIGHTS = (5, 2, 1)
SHARE, MOST_TIMES = 1.5, 2
SEED = "mix-1"
#: Rows of a bucket on average, and of a slice that is put in order, at most; slices that a range of finish times is cut into.
_ROWS, _SLICES = 1 << 17, 4096


def word_count(text) -> F.Column:
    """Runs of characters other than the six ASCII blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _numbered(per: DataFrame) -> DataFrame:
    """Rows (source, source_size) with turn: the place of the source in code point order, null last. Every
    range of the order is numbered by itself and begins where those before it end."""
    parts = int(per.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("source").asc_nulls_last()
    ranged = per.repartitionByRange(parts, order).sortWithinPartitions(order).withColumn("id", F.monotonically_increasing_id())
    ranged = materialize(ranged, "sources")
    counts = sorted(ranged.groupBy(F.shiftright("id", 33).alias("p")).count().collect())  # one row a range
    starts, so_far = [], 0
    for part, n in counts:
        starts += [F.lit(part), F.lit(so_far - (part << 33))]
        so_far += n
    if not starts:
        return per.select("source", "source_size", F.lit(0).cast("long").alias("turn"))
    turn = F.col("id") + F.element_at(F.create_map(*starts), F.shiftright("id", 33))
    return ranged.select("source", "source_size", turn.cast("long").alias("turn"))


def targets(sizes: DataFrame, share: float = SHARE, most_times: int = MOST_TIMES, weights=WEIGHTS) -> DataFrame:
    """A table (source, source_size, target) of rows (source, size): weighted shares, capped, by water-filling.

    The level (target for each unit of weight) starts where no source is at its cap; sources whose cap is
    below their share stand at it, the others share the rest, which raises the level, until none
    more comes to its cap. Every step is one aggregation."""
    per = _numbered(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("cap", F.lit(float(most_times)) * F.col("source_size"))
    per = materialize(per, "weights")
    total, level = (per.agg(F.sum("source_size")).first()[0] or 0) * float(share), -1.0
    while True:
        full = F.col("cap") / F.col("w") < F.lit(level)
        capped, open_ = per.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("w")))).first()
        now = (total - (capped or 0.0)) / open_ if open_ else float("inf")
        if now == level or not open_:
            break
        level = now
    target = F.least(F.col("cap"), F.col("w") * F.lit(now))
    return materialize(per.select("source", "source_size", target.alias("target")), "targets")


def _order(doc_id, text, size, seed: str) -> F.Column:
    """The place of a document in the order of its source, as 40 bytes."""
    shuffled = F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":" + seed))))
    return F.concat(shuffled, F.unhex(F.lpad(F.hex(size), 16, "0")), F.unhex(F.md5(F.coalesce(text, F.lit("")))))


def _last_time(copies: DataFrame, latest: float, budget: float) -> float:
    """The largest finish time up to which the words of all copies (size, v) are within the budget, 0 if none is."""
    low, high = 0.0, 1.0 + latest + 1e-9  # the order ends within them
    last, before = 0.0, 0  # what fits so far: its last finish time, its words
    while True:
        here = copies.where(F.col("v").between(low, high))
        if here.count() <= _ROWS:
            upto = F.sum("size").over(Window.orderBy("v")) + F.lit(before)
            end = here.select("v", upto.alias("upto")).where(F.col("upto") <= F.lit(budget)).agg(F.max("v")).first()[0]
            return last if end is None else end
        slices = here.groupBy(F.floor((F.col("v") - F.lit(low)) / F.lit((high - low) / _SLICES)).alias("slice"))
        for _, s, lo, hi in sorted(slices.agg(F.sum("size"), F.min("v"), F.max("v")).collect()):  # _SLICES rows
            if before + s > budget:
                break
            before, last = before + s, hi
        else:
            return last
        if lo == hi:  # all of this slice finish together, and do not fit
            return last
        low, high = lo, hi


def decide(rows: DataFrame, goal: DataFrame, most_times: int = MOST_TIMES) -> DataFrame:
    """One row a source (source, source_size, target, cuts): ``cuts`` has for each epoch the last key of the source's
    order that is taken (null: none). ``rows``: a table (source, key, size); ``goal``: of ``targets``."""
    wide = max(1, (max(0, rows.count() // _ROWS).bit_length() + 7) // 8)
    bucket = F.substring("key", 1, wide)
    sums = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("s"))
    so_far = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("s_source"), F.col("bucket").alias("s_bucket"), F.coalesce(F.sum("s").over(so_far), F.lit(0)).alias("start")
    )
    # equal keys share a place: the running sum takes them together
    within = Window.partitionBy("source", "bucket").orderBy("key")
    queue = rows.where("size > 0").withColumn("bucket", bucket).withColumn("upto", F.sum("size").over(within))
    same = F.col("source").eqNullSafe(F.col("s_source")) & (F.col("bucket") == F.col("s_bucket"))
    queue = queue.join(starts, same).withColumn("upto", F.col("upto") + F.col("start"))
    goals = goal.where("target > 0").withColumnRenamed("source", "g_source")
    queue = queue.join(maybe_broadcast(goals, 200), F.col("source").eqNullSafe(F.col("g_source")))
    finish = [(F.col("upto") + F.lit(k) * F.col("source_size")) / F.col("target") for k in range(most_times)]
    queue = materialize(queue.select("source", "key", "size", "target", F.array(*finish).alias("finish")), "queue")

    budget = goal.agg(F.sum("target")).first()[0] or 0.0
    # the order cannot end after the time at which every source has come up to its target
    latest = queue.agg(F.max(F.col("size") / F.col("target"))).first()[0] or 0.0
    last = _last_time(queue.select("size", F.explode("finish").alias("v")), latest, budget)
    taken = [F.max(F.when(F.element_at("finish", k + 1) <= F.lit(last), F.col("key"))) for k in range(most_times)]
    cuts = queue.groupBy(F.col("source").alias("c_source")).agg(F.array(*taken).alias("cuts"))
    found = goal.join(cuts, F.col("source").eqNullSafe(F.col("c_source")), "left")
    none = F.array(*[F.lit(None).cast("binary")] * most_times)
    return materialize(found.select("source", "source_size", "target", F.coalesce("cuts", none).alias("cuts")), "cuts")


_OUT = ("size", "source_size", "target", "taken")


def _taken(rows: DataFrame, cuts: DataFrame, source: str, key: str, size: str) -> DataFrame:
    """``rows`` with the decision for each: __source_size, __target, __taken."""
    c = cuts.select(*[F.col(x).alias(f"__{x}") for x in cuts.columns])
    out = rows.join(maybe_broadcast(c, 300), F.col(source).eqNullSafe(F.col("__source")))
    times = F.size(F.filter("__cuts", lambda x: F.col(key) <= x))
    return out.withColumn("__taken", (F.col(size) * times).cast("long"))


def _measured(docs: DataFrame, doc_id: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """``docs`` with __size, __at (its source, as text) and __key."""
    text = F.col(f"`{text_col}`").cast("string")
    out = docs.withColumn("__size", word_count(text)).withColumn("__at", F.col(f"`{source_col}`").cast("string"))
    return out.withColumn("__key", _order(F.col(f"`{doc_id}`").cast("long"), text, F.col("__size"), seed))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = SHARE,
    most_times: int = MOST_TIMES,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    rows = _measured(docs.select(doc_id, text_col, source_col), doc_id, text_col, source_col, seed)
    rows = rows.select(F.col(doc_id).cast("long").alias("doc_id"), F.col("__at").alias("source"), F.col("__key").alias("key"), F.col("__size").alias("size"))
    rows = materialize(rows, "sizes")
    cuts = decide(rows, targets(rows.select("source", "size"), share, most_times), most_times)
    out = _taken(rows, cuts, "source", "key", "size")
    return out.select("doc_id", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__taken").alias("taken"))


def mix_rows(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = SHARE,
    most_times: int = MOST_TIMES,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with size, source_size, target and taken of each row, in place: measured once for the decision,
    and once more where the row meets it, so that no text moves."""
    rows = _measured(docs.select(*dict.fromkeys((doc_id, text_col, source_col))), doc_id, text_col, source_col, seed)
    rows = materialize(rows.select(F.col("__at").alias("source"), F.col("__key").alias("key"), F.col("__size").alias("size")), "sizes")
    cuts = decide(rows, targets(rows.select("source", "size"), share, most_times), most_times)
    out = _taken(_measured(docs, doc_id, text_col, source_col, seed), cuts, "__at", "__key", "__size")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in _OUT]
    return out.select(*kept, *[F.col(f"__{c}").alias(c) for c in _OUT])
