"""Line dedup with two Bloom filters: one for line keys seen once, one for keys seen twice.

The key space is cut into slices by the key's digest (128 bits of BLAKE2b), as many as the counted lines
ask for. Every chunk of lines asks each slice about its distinct keys (once, however many of its
documents hold a key). A slice has a pair of bit maps for its part of the keys: a key that chunks or
documents bring a second time goes from ``once`` to ``twice``. Only what ``twice`` knows (repeats, and a few
false positives) is shuffled on, to be confirmed exactly and to find the first document that holds it;
the answer goes back to the chunks. No filter, key or answer passes through the driver, and a filter's
size depends on its slice only.

A line's key: the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Keys of at least
``min_chars`` code points found in at least two documents (distinct ids) lose all lines except
those of the document with the smallest id.

Defined cases: a null or empty text is one empty line, and its kept text is ''; all rows of equal id
are one document; rows without id count as one document that comes last. Other columns are carried
along; those named like an output column are replaced by it.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES, materialize, maybe_broadcast, texts

MIN_CHARS = 10
#: Bits of a filter for each key; keys of a slice on average, at most; (document, key) pairs of a chunk.
BITS_PER_KEY, SLICE_KEYS, CHUNK = 8, 1 << 20, 1 << 18
_PROBES = 3
_NO_ID = (1 << 63) - 1


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _keys(text: bytes | None, least: int) -> dict[bytes, None]:
    """Distinct keys of a text that are long enough, in order."""
    out = {}
    for line in (text or b"").split(b"\n"):
        key = line_key(line)
        if key not in out and _long_enough(key, least):
            out[key] = None
    return out


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers of each hash: ``_PROBES`` rows."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(_PROBES)])


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _probes(hashes, len(bitmap) * 8)
    return ((bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _put(bitmap: np.ndarray, hashes: np.ndarray) -> None:
    at = _probes(hashes, len(bitmap) * 8).ravel()
    np.bitwise_or.at(bitmap, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _halves(keys: bytes) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(keys, np.uint64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def line_chunks(docs: DataFrame, doc_id: str, text_col: str, least: int = MIN_CHARS) -> DataFrame:
    """A table of chunks: chunk, n, ids (longs) and keys (digests) of n (document, key) pairs."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, ids, keys = TaskContext.get().partitionId() << 32, [], []

        def row():
            columns = [pa.array([chunk]), pa.array([len(keys)], pa.int64()), pa.array([np.array(ids, np.int64).tobytes()]), pa.array([b"".join(keys)])]
            return pa.RecordBatch.from_arrays(columns, ["chunk", "n", "ids", "keys"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                found = list(map(_digest, _keys(text, least)))
                for k in range(0, len(found), CHUNK):  # a text may be longer than a chunk
                    part = found[k : k + CHUNK]
                    ids += [doc] * len(part)
                    keys += part
                    if len(keys) >= CHUNK:
                        yield row()
                        chunk, ids, keys = chunk + 1, [], []
        if keys:
            yield row()

    narrow = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text")
    )
    return materialize(narrow.mapInArrow(collect, "chunk long, n long, ids binary, keys binary"), "lines")


def _ask(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each chunk, for each slice: its distinct keys with the least and the largest id that holds them."""
    for batch in batches:
        for chunk, ids, keys in zip(*(batch.column(c).to_pylist() for c in ("chunk", "ids", "keys")), strict=True):
            ids, (a, b) = np.frombuffer(ids, np.int64), _halves(keys)
            order = np.lexsort((ids, b, a))
            ids, a, b = ids[order], a[order], b[order]
            first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            lo, hi = ids[first], ids[np.append(first[1:], len(ids)) - 1]
            pairs, part = np.stack([a[first], b[first]], axis=1), a[first] >> np.uint64(64 - bits) if bits else np.zeros(len(first), np.uint64)
            cuts = np.flatnonzero(np.append(np.append(True, part[1:] != part[:-1]), True)).tolist()
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(part[x]) for x, _ in spans], pa.int32()),
                    pa.array([chunk] * len(spans), pa.int64()),
                    *(pa.array([c[x:y].tobytes() for x, y in spans], pa.binary()) for c in (pairs, lo, hi)),
                ],
                ["slice", "chunk", "keys", "lo", "hi"],
            )


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys (key, chunk, lo, hi) that a slice's ``twice`` knows; rows come in order of the slice."""

    def told(asked: list[tuple]):
        once, twice = slice_filters([(_halves(keys)[0], np.frombuffer(lo, np.int64) < np.frombuffer(hi, np.int64)) for _, keys, lo, hi in asked])
        for chunk, keys, lo, hi in asked:
            hit = np.flatnonzero(_has(twice, _halves(keys)[0]))
            if len(hit):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[16 * k : 16 * k + 16] for k in hit.tolist()], pa.binary()),
                        pa.array([chunk] * len(hit), pa.int64()),
                        pa.array(np.frombuffer(lo, np.int64)[hit]),
                        pa.array(np.frombuffer(hi, np.int64)[hit]),
                    ],
                    ["key", "chunk", "lo", "hi"],
                )

    now, held = None, []
    for batch in batches:
        for number, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if number != now:
                if held:
                    yield from told(held)
                now, held = number, []
            held.append(row)
    if held:
        yield from told(held)


def slice_filters(asked: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The bit maps ``once`` and ``twice`` of (hashes, whether two documents of one chunk hold them)."""
    bits = max(64, 1 << (sum(len(h) for h, _ in asked) * BITS_PER_KEY).bit_length())
    once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    for hashes, both in asked:
        _put(twice, hashes[both | _has(once, hashes)])
        _put(once, hashes)
    return once, twice


def repeated_keys(docs: DataFrame, doc_id: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows (id, keys): digests of the keys that the document has to lose."""
    lines = line_chunks(docs, doc_id, text_col, min_chars)
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(24, max((lines.agg(F.sum("n")).first()[0] or 0) // SLICE_KEYS, least - 1).bit_length())
    asked = lines.mapInArrow(functools.partial(_ask, bits), "slice int, chunk long, keys binary, lo binary, hi binary")
    dealt = asked.repartition(1 << bits, "slice").sortWithinPartitions("slice")
    found = materialize(dealt.mapInArrow(_suspects, "key binary, chunk long, lo long, hi long"), "suspects")
    first = found.groupBy("key").agg(F.min("lo").alias("keep"), F.max("hi").alias("last")).where("keep < last")
    first = materialize(first.select("key", "keep"), "first")
    # a chunk gets the answer to what it asked, at most CHUNK keys
    back = found.select("key", "chunk").join(maybe_broadcast(first, 60), "key")
    back = materialize(back.groupBy("chunk").agg(F.collect_list("key").alias("gone"), F.collect_list("keep").alias("keep")), "answers")
    held = back.agg(F.sum(40 + 24 * F.size("gone"))).first()[0] or 0

    def lose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, keys, gone, keep in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                of, out = dict(zip(gone, keep, strict=True)), {}
                for k, doc in enumerate(np.frombuffer(ids, np.int64).tolist()):
                    key = keys[16 * k : 16 * k + 16]
                    if doc > of.get(key, doc):
                        out.setdefault(doc, []).append(key)
                yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.list_(pa.binary()))], ["id", "keys"])

    joined = lines.join(F.broadcast(back) if held <= BROADCAST_BYTES else back, "chunk").select("ids", "keys", "gone", "keep")
    drops = joined.mapInArrow(lose, "id long, keys array<binary>")
    return drops.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"))


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """``docs`` with the kept text, and the columns n_lines (before) and n_dropped."""
    drops = materialize(repeated_keys(docs, doc_id, text_col, min_chars), "drops")
    held = drops.agg(F.sum(40 + 24 * F.size("keys"))).first()[0] or 0
    carried = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    left = docs.select(*[docs[f"`{c}`"] for c in carried])
    left = left.withColumn("__id", F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NO_ID)))
    left = left.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    right = drops.select(F.col("id").alias("__id"), F.col("keys").alias("__keys"))
    joined = left.join(F.broadcast(right) if held <= BROADCAST_BYTES else right, "__id", "left").drop("__id")
    at = carried.index(text_col)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, before, dropped = [], [], []
            for text, keys in zip(texts(batch.column(at)), batch.column(len(carried)).to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                before.append(len(lines))
                if keys:
                    lose, stay = set(keys), []
                    for line in lines:
                        key = line_key(line)
                        if not (_long_enough(key, min_chars) and _digest(key) in lose):
                            stay.append(line)
                    lines = stay
                dropped.append(before[-1] - len(lines))
                kept.append(b"\n".join(lines))
            columns = list(batch.columns[: len(carried)])
            columns[at] = pa.array(kept, pa.binary()).cast(pa.string())
            columns += [pa.array(before, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*carried, "n_lines", "n_dropped"])

    schema = T.StructType(
        [*joined.schema.fields[: len(carried)], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )
    return joined.mapInArrow(rebuild, schema)
