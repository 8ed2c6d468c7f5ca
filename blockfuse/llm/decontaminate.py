"""Benchmark decontamination with a distributed positional inverted index.

Training texts are tokenised into *segments* of about ``segment_tokens`` tokens; every segment is one
row of the index table and stores, for each of its terms, the list of positions (delta coded).
Queries are evaluated segment by segment: for a phrase the lists of its terms are taken from the
rarest term on, shifted by the term's offset in the phrase and intersected, until nothing is left
or every term has been confirmed. Nothing of the corpus is shuffled; only hits are.

Words: A-Z lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` (digits, a-z, everything
beyond ASCII).

Defined cases: a null or empty text has no words and is never hit; a benchmark item without words has
no window; null ids are carried through; repeated rows are judged one by one; extra columns are
ignored, whatever their names. Rows whose item_id is null match, but add no id to the item lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, texts

WINDOW = 13
SEGMENT_TOKENS = 1 << 20
#: Windows that one pass ships to the executors; a larger benchmark takes several passes.
BLOCK_WINDOWS = 200_000

# Maps A-Z to a-z and every byte that cannot be part of a word to a space.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class _Terms(dict):
    """Numbers terms as they appear."""

    def __missing__(self, term):
        self[term] = n = len(self)
        return n


_SEGMENTS = (
    "seg long, doc_ids array<long>, lengths array<int>, terms array<string>, counts array<int>, postings binary"
)
_ARROW = pa.schema(
    [
        ("seg", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("terms", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int32())),
        ("postings", pa.binary()),
    ]
)


def build_index(docs: DataFrame, id_col: str, text_col: str, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """The positional index of all texts, written to the shared folder: one row per segment.

    Documents are numbered in a segment in the order of ``doc_ids``; between two of them one
    position stays free, so that no phrase crosses a border. A document is never split.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        packer = zstandard.ZstdCompressor(level=1)

        def flush():
            ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
            used = ids >= 0
            order = np.argsort(ids, kind="stable").astype(np.int32)
            order = order[len(ids) - int(used.sum()) :]
            counts = np.bincount(ids[used], minlength=len(terms)).astype(np.int32)
            gaps = np.diff(order, prepend=np.int32(0)).astype(np.int32)
            names = pa.array(list(terms), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([serial], pa.int64()),
                    pa.array([doc_ids], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int32())),
                    pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                    pa.array([counts], pa.list_(pa.int32())),
                    pa.array([packer.compress(gaps.tobytes())], pa.binary()),
                ],
                schema=_ARROW,
            )

        terms, parts, doc_ids, lengths, total = _Terms(), [], [], [], 0
        border = np.array([-1], np.int32)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                found = words(text)
                doc_ids.append(doc_id)
                lengths.append(len(found))
                if found:
                    parts.append(np.fromiter(map(terms.__getitem__, found), np.int32, len(found)))
                parts.append(border)
                total += len(found) + 1
                if total >= segment_tokens:
                    yield flush()
                    serial += 1
                    terms, parts, doc_ids, lengths, total = _Terms(), [], [], [], 0
        if doc_ids:
            yield flush()

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return materialize(narrow.mapInArrow(build, _SEGMENTS), "postings")


class _Segment:
    """A segment's lists, read when asked for."""

    def __init__(self, batch: pa.RecordBatch, row: int, query_terms: pa.Array):
        self.seg = batch.column(0)[row].as_py()
        lengths = batch.column(2)[row].values.to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]) if len(lengths) else np.empty(0, np.int64)
        names = batch.column(3)[row].values
        self.counts = batch.column(4)[row].values.to_numpy(zero_copy_only=False)
        self.ends = np.cumsum(self.counts, dtype=np.int64)
        raw = zstandard.ZstdDecompressor().decompress(batch.column(5)[row].as_py())
        self.postings = np.cumsum(np.frombuffer(raw, np.int32), dtype=np.int32)
        #: number of each query term in this segment, -1 where it does not occur
        self.number = pc.fill_null(pc.index_in(query_terms, value_set=names), -1).to_numpy(zero_copy_only=False)

    def positions(self, term: int) -> np.ndarray:
        k = self.number[term]
        return self.postings[self.ends[k] - self.counts[k] : self.ends[k]]

    def frequency(self, terms: np.ndarray) -> np.ndarray:
        k = self.number[terms]
        return np.where(k >= 0, self.counts[np.maximum(k, 0)], 0) if len(self.counts) else np.zeros(len(terms), int)

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Positions at which the phrase begins."""
        often = self.frequency(terms)
        if not often.all():
            return np.empty(0, np.int64)
        order = np.argsort(often, kind="stable")
        at = self.positions(terms[order[0]]).astype(np.int64) - order[0]
        for k in order[1:]:
            listed = self.positions(terms[k])
            wanted = at + k
            near = np.minimum(np.searchsorted(listed, wanted), len(listed) - 1)
            at = at[listed[near] == wanted]
            if not len(at):
                break
        return at

    def near(self, terms: np.ndarray, slop: int) -> np.ndarray:
        """(first, end) of the shortest spans of one document that hold every term in any order, at
        most ``slop`` words longer than the number of terms; spans begin at each place of the rarest
        term's neighbourhood and only minimal ones are returned."""
        often = self.frequency(terms)
        distinct = np.unique(terms)
        if not often.all():
            return np.empty((0, 2), np.int64)
        need = {int(t): int((terms == t).sum()) for t in distinct}
        width = len(terms) + slop
        rare = int(terms[np.argmin(often)])
        out = set()
        for p in self.positions(rare).tolist():
            events = []
            for t in need:
                listed = self.positions(t)
                a, b = np.searchsorted(listed, [p - width + 1, p + width])
                events += [(int(x), t) for x in listed[a:b]]
            doc = np.searchsorted(self.starts, p, "right") - 1
            low = self.starts[doc]
            high = self.starts[doc + 1] if doc + 1 < len(self.starts) else np.inf
            events = sorted(e for e in events if low <= e[0] < high)
            have, missing, left = dict.fromkeys(need, 0), len(need), 0
            for pos, t in events:
                have[t] += 1
                missing -= have[t] == need[t]
                while not missing:
                    first, u = events[left]
                    if pos - first < width:
                        out.add((first, pos + 1))
                    have[u] -= 1
                    missing += have[u] < need[u]
                    left += 1
        # a span is minimal if none that begins at or after it ends at or before its end
        minimal, least = [], np.inf
        for s in sorted(out, key=lambda x: (-x[0], x[1])):
            if s[1] < least:
                minimal.append(s)
                least = s[1]
        minimal.reverse()
        return np.array(minimal, np.int64).reshape(-1, 2)


def windows_of(text: bytes | None, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    """Each run of ``window`` words; of fewer words, but not none, all of them."""
    return list(_windows(text, window))


def _windows(text: bytes | None, window: int) -> Iterator[tuple[bytes, ...]]:
    found = words(text)
    if found:
        yield from (tuple(found[k : k + window]) for k in range(max(1, len(found) - window + 1)))


def _query_blocks(items: DataFrame, id_col: str, text_col: str, window: int, block: int):
    """Blocks of at most ``block`` distinct windows, read one item at a time (an item of more windows goes on in
    the next block): (terms, windows as term numbers, item ids)."""
    terms, rows, ids = _Terms(), [], []
    for row in items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator():
        seen: set = set()  # of this item in this block
        for w in _windows(row[1].encode() if row[1] is not None else None, window):
            if w in seen:
                continue
            if len(rows) >= block:
                yield list(terms), rows, ids
                terms, rows, ids, seen = _Terms(), [], [], set()
            seen.add(w)
            rows.append(np.fromiter(map(terms.__getitem__, w), np.int32, len(w)))
            ids.append(row[0])
    if rows:
        yield list(terms), rows, ids


_HITS = "seg long, ord int, item_id long, spans array<struct<s:int,e:int>>"


def matches(
    index: DataFrame,
    items: DataFrame,
    id_col: str,
    text_col: str,
    window: int = WINDOW,
    slop: int | None = None,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Rows (seg, ord, item_id, spans): the places, as word offsets in the document, at which windows
    of the item occur. ``slop`` None: exact phrases; else spans that hold all words of a window in
    any order and are at most ``slop`` words longer.

    The benchmark is taken in blocks of bounded size, each shipped to all segments; the union of the
    blocks' hits is returned.
    """
    spark = index.sparkSession
    out = None
    for block in _query_blocks(items, id_col, text_col, window, block_windows):
        shipped = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            names, rows, ids = shipped.value
            query_terms = pa.array(names, pa.binary()).cast(pa.string())
            for batch in batches:
                for k in range(batch.num_rows):
                    segment = _Segment(batch, k, query_terms)
                    known = segment.number >= 0
                    found: dict[tuple, list] = {}
                    for terms, item in zip(rows, ids, strict=True):
                        if not known[terms].all():
                            continue
                        if slop is None:
                            at = segment.phrase(terms)
                            spans = np.stack([at, at + len(terms)], axis=1)
                        else:
                            spans = segment.near(terms, slop)
                        if not len(spans):
                            continue
                        docs = np.searchsorted(segment.starts, spans[:, 0], "right") - 1
                        spans = spans - segment.starts[docs][:, None]
                        for d, (s, e) in zip(docs.tolist(), spans.tolist(), strict=True):
                            found.setdefault((d, item), []).append((s, e))
                    if found:
                        yield pa.RecordBatch.from_pydict(
                            {
                                "seg": pa.array([segment.seg] * len(found), pa.int64()),
                                "ord": pa.array([d for d, _ in found], pa.int32()),
                                "item_id": pa.array([i for _, i in found], pa.int64()),
                                "spans": pa.array(
                                    [[{"s": s, "e": e} for s, e in _merged(x)] for x in found.values()],
                                    pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])),
                                ),
                            }
                        )

        hits = index.mapInArrow(search, _HITS)
        out = hits if out is None else out.unionByName(hits)
    return out if out is not None else spark.createDataFrame([], _HITS)


def _merged(spans: list) -> list:
    """Touching or overlapping spans as one."""
    out: list = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = 20,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans.

    ``contaminated``: n_hit > 0 and share * n_hit >= n_words.
    """
    index = build_index(docs, doc_id, doc_text)
    hits = matches(index, items, item_id, item_text, window)
    per_doc = hits.groupBy("seg", "ord").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    rows = index.select("seg", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("ord", "d")).select(
        "seg", "ord", F.col("d.doc_ids").alias("doc_id"), F.col("d.lengths").cast("long").alias("n_words")
    )
    covered = F.expr(
        "aggregate(spans, named_struct('n', 0L, 'to', 0), (a, x) -> named_struct("
        "'n', a.n + greatest(0, x.e - greatest(a.to, x.s)), 'to', greatest(a.to, x.e)), a -> a.n)"
    )
    none = F.array().cast("array<string>")
    return (
        rows.join(per_doc, ["seg", "ord"], "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            "spans",
        )
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
            ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
            "items",
            "spans",
        )
    )
