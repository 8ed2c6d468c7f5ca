"""N-gram Jaccard self-join with adaptive multi-match prefixes, down to connected components.

A document is the set of its distinct ``words``-word shingles (64-bit hashes). Two documents link when
``100 * |x & y| >= percent * |x | y|``. All sets are ordered by one global order, rare shingles first;
the order comes from a fixed-size count sketch that is summed over the shingles of every document.

* Documents of equal sets are one *class* (128 bits of BLAKE2b over the sorted hashes).
* A class may use a prefix of level L: its first ``n - ceil(percent * n) + L`` shingles. Two classes
  that link share at least L shingles of their L-prefixes. L is chosen for each class: a longer
  prefix costs more list entries, but its candidates need L shared shingles; the class takes the L
  that minimises ``entries + VERIFY * entries / L``, entries being the sketch's frequencies in excess
  of the sketch's noise. A pair counts matches at the smaller of its two levels.
* Most prefix shingles are in one class only. Packed by slices of the hash space, about six bytes an
  entry, all entries pass once through the tasks that know which shingles at least two classes
  hold; only those become list entries. Repeats of a class in other tasks are left out beforehand.
* Lists of at most ``SMALL`` classes give all their pairs. A longer list (one passage in many
  documents, a large group of near copies) first gives one pair of each member with a hub, which is
  verified; as most members of such lists are thereby in one component, only pairs of members in
  *different* components remain. While their number is large, the members outside of a list's largest
  component are paired with a few of its members (HUBS, drawn anew); what is left is compared within
  the list by signatures, in tiles of at most ``TILE`` members: first the nearest ones of each member, which
  joins most components that link, then all pairs of different components. So no link between components is lost.
  Very frequent shingles are salted, so that a list spreads over tasks; its parts meet again later.
* The *signature* of a set: for each of B cells (B a power of two of at least n and LEAST_CELLS) the parity of the
  number of its hashes there. Parities that differ are no more than the hashes that only one of
  two sets has, so a pair with more of them than a link allows is passed over, and no link is. The
  signature has a thirtieth to a sixtieth of the set's bytes; it folds to any smaller power of two.
* What is left is verified on the whole sets, which only the classes of such pairs send.

Words are hashed by tabulation: the sum of one random 64-bit value for each (place, byte); words of more
than 64 bytes by XXH3. A shingle's hash is a polynomial in its words' hashes, mixed.

Defined cases: words are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z. A text of fewer words than
``words``, but not none, is one shingle, equal only to the same sequence; a null, empty or blank text
has no shingles, links with nothing and is its own component. Repeated rows fall in one class. Ids
that are null take part, but are never the smallest of a component that has an id. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, maybe_broadcast, texts
from .graph import components

WORDS, PERCENT = 5, 75
SKETCH_BITS = 20
#: Bits of a shingle's hash that name its list, and entries that a slice of the hash space has on average at most.
TOK_BITS, SLICE_ENTRIES = 48, 1 << 21
#: Most members of a list that gives all its pairs; most hub rounds; highest prefix level.
SMALL, ROUNDS, MOST_LEVEL = 8, 4, 8
#: Members of a list's largest component that the others are paired with in a round; rounds go on while more
#: than so many pairs are left for each list entry and each halves them; members of a tile.
HUBS, OPEN_PAIRS, TILE = 8, 1024, 2048
#: Members that each is compared with first, within its tile, and how often.
NEAREST, NEAR_ROUNDS = 4, 1
#: Cells of a signature at least.
LEAST_CELLS = 1 << 10
#: What verifying a candidate costs, in list entries.
VERIFY = 4.0
#: Estimated members of a list beyond which it is salted, and most salts.
SALT_ROWS, MOST_SALTS = 1 << 15, 1 << 12
_SKETCH_BLOCK = 1 << 14
#: Entries of a task that are packed together.
_CHUNK_ENTRIES = 1 << 20

_M = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
#: Texts are hashed together in chunks of about so many bytes; words in runs of so many.
_CHUNK, _RUN = 1 << 18, 1 << 16
_LONG_WORD = 64


def _table() -> np.ndarray:
    """Random values for each (place, byte), equal for the two cases of A-Z."""
    out = np.random.Generator(np.random.PCG64(20)).integers(0, _M, (_LONG_WORD, 256), np.uint64, endpoint=True)
    out[:, 0x41:0x5B] = out[:, 0x61:0x7B]
    return out.ravel()


_VALUE = _table()
_BLANK = np.array([b in (0x20, 9, 10, 11, 12, 13) for b in range(256)])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of each word."""
    raw = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(_BLANK[raw], prepend=True, append=True))
    first, length = edge[::2], edge[1::2] - edge[::2]
    h = np.empty(len(first), np.uint64)
    for k in range(0, len(first), _RUN):
        f, n = first[k : k + _RUN], np.minimum(length[k : k + _RUN], _LONG_WORD)
        at = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(at, n)
        value = _VALUE[(place << 8) | raw[np.repeat(f, n) + place]]
        h[k : k + _RUN] = np.add.reduceat(value, at)
    h = _mixed(h + length.astype(np.uint64) * np.uint64(_BASE))
    for k in np.flatnonzero(length > _LONG_WORD).tolist():
        h[k] = xxhash.xxh3_64_intdigest(data[first[k] : first[k] + length[k]].lower())
    return first, h


def shingle_sets(found: Iterable[bytes | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text, in order."""
    held, size = [], 0
    for text in found:
        held.append(text or b"")
        size += len(held[-1]) + 1
        if size >= _CHUNK:
            yield from _sets(held, words)
            held, size = [], 0
    if held:
        yield from _sets(held, words)


def _sets(held: list[bytes], words: int) -> Iterator[np.ndarray]:
    starts = np.cumsum([0, *(len(t) + 1 for t in held)])
    first, h = _word_hashes(b" ".join(held) + b" ")
    n = max(len(h) - words + 1, 0)
    s = h[:n].copy()
    for k in range(1, words):
        s *= np.uint64(_BASE)
        s += h[k : k + n]
    s = _mixed(s)
    cuts = np.searchsorted(first, starts).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a >= words:
            yield np.unique(s[a : b - words + 1])
        elif b > a:  # all of a short text is one shingle, told from others by its number of words
            one = np.uint64(b - a)
            for x in h[a:b]:
                one = _mixed(np.array([one]) * np.uint64(_BASE) + x)[0]
            yield np.array([one], np.uint64)
        else:
            yield np.empty(0, np.uint64)


def class_id(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def signature(hashes: np.ndarray) -> bytes:
    """Parities of the numbers of hashes in each of B cells, 64 at least."""
    cells = max(LEAST_CELLS, 1 << (len(hashes) - 1).bit_length())
    at = (hashes & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=cells).astype(np.uint8) & 1).tobytes()


def _folded(sig: np.ndarray, width: int) -> np.ndarray:
    """Signatures (rows of 64-bit words) of as many cells as ``width`` words have."""
    while sig.shape[-1] > width:
        half = sig.shape[-1] // 2
        sig = sig[..., :half] ^ sig[..., half:]
    return sig


def _need(na, nb, percent: int):
    """The least number of shingles that linked sets of these sizes share."""
    return -(-percent * (na + nb) // (100 + percent))


def least_overlap(n, percent: int):
    """ceil(percent * n / 100): the least that a set of n shares with any set it links with."""
    return -(-percent * n // 100)


def sketch(narrow: DataFrame, words: int) -> np.ndarray:
    """Counts of shingles by the top SKETCH_BITS bits of their hash, over all documents."""
    size = 1 << SKETCH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            sets, waiting = [], 0
            for found in shingle_sets(texts(batch.column("text")), words):
                sets.append(found >> np.uint64(64 - SKETCH_BITS))
                waiting += len(sets[-1])
                if waiting > size:
                    held += np.bincount(np.concatenate(sets).astype(np.int64), minlength=size)
                    sets, waiting = [], 0
            if waiting:
                held += np.bincount(np.concatenate(sets).astype(np.int64), minlength=size)
        yield from _sketch_rows(held.reshape(-1, _SKETCH_BLOCK), range(size // _SKETCH_BLOCK))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held = zstandard.ZstdDecompressor().decompress, {}
        for batch in batches:
            for block, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                got = np.frombuffer(unpack(packed), np.int64)
                held[block] = held[block] + got if block in held else got
        yield from _sketch_rows(list(held.values()), held)

    shape = "block int, counts binary"
    out = np.zeros(size, np.int64).reshape(-1, _SKETCH_BLOCK)
    unpack = zstandard.ZstdDecompressor().decompress
    for row in narrow.mapInArrow(count, shape).repartition("block").mapInArrow(add, shape).toLocalIterator():
        out[row[0]] = np.frombuffer(unpack(bytes(row[1])), np.int64)
    return out.reshape(-1)


def _sketch_rows(parts, blocks) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for block, counts in zip(blocks, parts, strict=True):
        if counts.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([pack(counts.tobytes())], pa.binary())], ["block", "counts"]
            )


def choose_level(excess: np.ndarray, base: int) -> int:
    """``excess``: what the sketch says of the shingles in order; ``base``: shingles of the 1-prefix."""
    most = min(MOST_LEVEL, len(excess) - base + 1)
    entries = np.cumsum(excess[: base + most - 1])[base - 1 :]
    level = np.arange(1, most + 1)
    return int(np.argmin(entries + VERIFY * entries / level)) + 1


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers as byte planes, compressed."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(data: bytes, n: int, *kinds) -> list[np.ndarray]:
    raw, out, at = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), [], 0
    for kind in kinds:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(kind).ravel())
        at += n * width
    return out


#: A class's number: the task, the chunk in it, and its place there.
_PLACE_BITS = 16
_PREFIXES = "doc_id long, n long, cls binary, id long, sig binary, slice int, salted boolean, chunk long, entries int, members int, data binary, about binary"


def prefixes(narrow: DataFrame, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """A table of two kinds of rows. Documents: doc_id, n, cls, and for the first of a class in a chunk its id and
    sig. Packed list entries: slice, salted, chunk, entries and data, that is (tok, member, pos) and for
    salted ones the salt; members and about, that is (place, n, ell) of each."""
    noise = int(np.median(counts)) if counts.any() else 0
    spark = narrow.sparkSession
    shipped = spark.sparkContext.broadcast(np.minimum(counts, 0xFFFFFFFF).astype(np.uint32))
    # slices: so many that each task's are small, and at least a few for each partition
    expected = int(counts.sum()) * (100 - percent) // 100
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(24, max(expected // SLICE_ENTRIES, least - 1).bit_length())
    kinds = pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()
    names = [f.split()[0] for f in _PREFIXES.split(", ")]

    def rows(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, chunk = shipped.value, TaskContext.get().partitionId() << 16
        seen, held, sizes, size = set(), [], [], 0

        def packed():
            tok, ref, pos, salt = (np.concatenate(c) for c in zip(*held, strict=True))
            n, ell = (np.array(c, np.uint32) for c in zip(*sizes, strict=True))
            route = np.where(salt > 0, _mixed(tok + salt.astype(np.uint64) * np.uint64(_BASE)) >> np.uint64(64 - TOK_BITS), tok)
            part = (route >> np.uint64(TOK_BITS - bits)).astype(np.int64) * 2 + (salt > 0)
            order = np.lexsort((tok, part))
            tok, ref, pos, salt, part = (c[order] for c in (tok, ref, pos, salt, part))
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-2))
            out = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                step = np.diff(tok[a:b], prepend=np.uint64(0))
                more = (salt[a:b],) if part[a] & 1 else ()
                places, member = np.unique(ref[a:b], return_inverse=True)
                data = _pack(step, member.astype(np.uint32), pos[a:b], *more)
                about = _pack(np.diff(places, prepend=np.uint32(0)), n[places], ell[places])
                out.append((None,) * 5 + (int(part[a]) >> 1, bool(part[a] & 1), chunk, b - a, len(places), data, about))
            return rows(zip(*out, strict=True))

        for batch in batches:
            docs = []
            for s in shingle_sets(texts(batch.column("text")), words):
                n = len(s)
                if not n:
                    docs.append((0,) + (None,) * 10)
                    continue
                cls = class_id(s)
                if cls in seen:
                    docs.append((n, cls) + (None,) * 9)
                    continue
                ref = len(seen)
                seen.add(cls)
                freq = often[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                base = n - least_overlap(n, percent) + 1
                order = np.argsort(freq, kind="stable")[: base + MOST_LEVEL - 1]
                excess = np.maximum(freq[order].astype(np.float64) - noise, 0) + 1
                ell = choose_level(excess, base)
                tok = s[order] >> np.uint64(64 - TOK_BITS)
                if len(np.unique(tok)) < len(tok):  # matches can't be counted where two have one name: one is enough
                    ell = 1
                tok, freq = tok[: base + ell - 1], freq[order[: base + ell - 1]].astype(np.int64)
                parts = np.clip((freq - 2 * noise) // SALT_ROWS, 0, MOST_SALTS) + 1
                salt = np.where(parts > 1, 1 + int.from_bytes(cls[:4], "little") % parts, 0).astype(np.uint32)
                held.append((tok, np.full(len(tok), ref, np.uint32), np.arange(len(tok), dtype=np.uint32), salt))
                sizes.append((n, ell))
                size += len(tok)
                docs.append((n, cls, chunk << _PLACE_BITS | ref, signature(s)) + (None,) * 7)
                if size >= _CHUNK_ENTRIES or len(seen) >= 1 << _PLACE_BITS:
                    yield packed()
                    chunk, seen, held, sizes, size = chunk + 1, set(), [], [], 0
            if docs:
                yield rows([batch.column("doc_id"), *zip(*docs, strict=True)])
        if held:
            yield packed()

    return materialize(narrow.mapInArrow(build, _PREFIXES), "prefixes")


def shared_entries(table: DataFrame, classes: DataFrame) -> DataFrame:
    """List entries (tok, salt, id, n, pos, ell) of the shingles that two classes or more hold (or that are
    salted), one for each class: all others stay packed."""
    again = table.where("id is not null").select("id").join(classes.select("id"), "id", "left_anti")
    place = F.col("id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")
    again = again.groupBy(F.shiftright("id", _PLACE_BITS).alias("chunk")).agg(F.collect_list(place).alias("again"))
    again = materialize(again, "again")  # a row is bounded by its chunk
    asked = table.where("slice is not null").select("slice", "salted", "chunk", "entries", "members", "data", "about")
    held = again.agg(F.sum(F.size("again") * 4 + 40)).first()[0] or 0
    asked = asked.join(F.broadcast(again) if held <= 32 << 20 else again, "chunk", "left")
    slices = table.agg(F.max("slice")).first()[0]
    dealt = asked.repartition(1 if slices is None else slices + 1, "slice").sortWithinPartitions("slice")
    names, kinds = ["tok", "salt", "id", "n", "pos", "ell"], (np.int64, np.int32, np.int64, np.int32, np.int32, np.int32)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def rows(*columns):
            for k in range(0, len(columns[0]), 1 << 16):
                part = slice(k, k + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(c[part].astype(t)) for c, t in zip(columns, kinds, strict=True)], names)

        def shared():
            tok, salt, *rest = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.argsort(tok, kind="stable")
            tok = tok[order]
            same = np.zeros(len(tok), bool)
            same[1:] = tok[1:] == tok[:-1]
            same[:-1] |= same[1:]
            order = order[same]
            return rows(tok[same], salt[order], *(c[order] for c in rest))

        for batch in batches:
            for number, salted, chunk, entries, members, data, about, again in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if number != now:
                    if held:
                        yield from shared()
                    now, held = number, []
                step, member, pos, *salt = _unpack(data, entries, np.uint64, np.uint32, np.uint32, *([np.uint32] if salted else []))
                places, n, ell = _unpack(about, members, np.uint32, np.uint32, np.uint32)
                places = np.cumsum(places)
                tok, salt = np.cumsum(step, dtype=np.uint64), salt[0] if salted else np.zeros(entries, np.uint32)
                found = tok, salt, (chunk << _PLACE_BITS | places.astype(np.int64))[member], n[member], pos, ell[member]
                if again:
                    stay = ~np.isin(places, np.array(again))[member]
                    found = tuple(c[stay] for c in found)
                if salted:
                    yield from rows(*found)
                elif len(found[0]):
                    held.append(found)
        if held:
            yield from shared()

    columns = ["slice", "salted", "chunk", "entries", "members", "data", "about", "again"]
    return dealt.select(*columns).mapInArrow(pick, "tok long, salt int, id long, n int, pos int, ell int")


_MEETINGS = "kind int, tok long, a long, b long, ell int, sure boolean"


def meetings(entries: DataFrame, percent: int) -> DataFrame:
    """What the lists give: rows of kind 0 (a pair a, b of a short list with the pair's level ell), 1 (hub
    a, member b) and 2 (a long list's member a). A part of a salted list counts as long, however many members
    it has.

    A pair is passed over where its positions in the two orders leave too few shingles for the
    overlap it needs: of the first L shared shingles, the i-th (from 0) leaves at least that less i.
    ``sure`` marks what the first one fulfils."""
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = entries.repartition(parts, "tok", "salt").sortWithinPartitions("tok", "salt", "id", "pos")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the list being read, up to SMALL + 1 members
        long_list, key, last = False, None, None
        out: list[tuple] = []

        def pairs():
            if key[1]:
                for m in held:
                    linked(m)
                return
            for j in range(1, len(held)):
                cb, nb, pb, eb = held[j]
                for i in range(j):
                    ca, na, pa_, ea = held[i]
                    ell, need = min(ea, eb), -(-percent * (na + nb) // (100 + percent))
                    room = min(na - pa_, nb - pb)
                    most = -(-percent * na // 100), -(-percent * nb // 100)
                    if room >= need - ell + 1 and pa_ <= na - most[0] + ell - 1 and pb <= nb - most[1] + ell - 1:
                        out.append((0, key[0], ca, cb, ell, room >= need))

        def linked(member):
            out.append((2, key[0], member[0], None, None, None))
            hub = held[0]
            need = -(-percent * (hub[1] + member[1]) // (100 + percent))
            if member is not hub and min(hub[1] - hub[2], member[1] - member[2]) >= need - MOST_LEVEL:
                out.append((1, None, hub[0], member[0], None, None))

        def rows():
            names = [f.split()[0] for f in _MEETINGS.split(", ")]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names
            )

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            tok, salt = cols[0], cols[1]
            # lists of one member within the batch are passed over at once
            same = (tok[1:] == tok[:-1]) & (salt[1:] == salt[:-1])
            take = np.zeros(len(tok), bool)
            take[1:] |= same
            take[:-1] |= same
            take |= salt > 0
            if len(take):
                take[0] = take[-1] = True
            for t, s, cls, n, pos, ell in zip(*(c[take].tolist() for c in cols), strict=True):
                if (t, s) != key:
                    if not long_list and held:
                        pairs()
                    held, long_list, key, last = [], False, (t, s), None
                if cls == last:  # a class of which two shingles have one name
                    continue
                last = cls
                member = (cls, n, pos, ell)
                if long_list:
                    linked(member)
                    continue
                held.append(member)
                if len(held) > SMALL:
                    long_list = True
                    for m in held:
                        linked(m)
                    del held[1:]
            if len(out) > 50_000:
                yield rows()
                out.clear()
        if not long_list and held:
            pairs()
        if out:
            yield rows()

    return materialize(dealt.mapInArrow(meet, _MEETINGS), "meetings")


def candidates(met: DataFrame) -> DataFrame:
    """Pairs (a, b) to verify first: hub pairs, and pairs of short lists that share as many shingles as
    their level asks for; where both are also in long lists, which may hold the rest, one is enough."""
    short = met.where("kind = 0").groupBy("a", "b")
    short = short.agg(((F.count("*") >= F.min("ell")) & F.bool_or("sure")).alias("enough"))
    in_long = met.where("kind = 2").select(F.col("a").alias("c")).distinct()
    rest = (
        short.where("not enough")
        .join(in_long.withColumnRenamed("c", "a"), "a", "left_semi")
        .join(in_long.withColumnRenamed("c", "b"), "b", "left_semi")
    )
    hubs = met.where("kind = 1")
    order = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return order(hubs).unionByName(order(short.where("enough"))).unionByName(order(rest)).distinct()



def possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) those that link as far as the signatures tell."""
    x = classes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    y = classes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    y = y.join(maybe_broadcast(pairs.select("b").distinct(), 16), "b", "left_semi")
    both = y.join(x.join(maybe_broadcast(pairs, 32), "a"), "b").select("a", "b", "na", "nb", "sa", "sb")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, nb, sa, sb in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                x, y = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
                width = min(len(x), len(y))
                apart = int(np.bitwise_count(_folded(x, width) ^ _folded(y, width)).sum())
                keep.append(apart <= na + nb - 2 * _need(na, nb, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return materialize(both.mapInArrow(test, "a long, b long"), "possible")


def whole_sets(narrow: DataFrame, table: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Table (id, s): the whole sets of the wanted classes, each sent by its document of least id (rows of one
    class that share this id send it once each, which repeats links but adds none). Only the texts of
    senders are hashed again; rows without id, which no key can tell apart, all are."""
    known = classes.select("id", "cls").join(maybe_broadcast(wanted.distinct(), 16), "id", "left_semi")
    rows = table.where("cls is not null").select("cls", "doc_id")
    senders = rows.join(maybe_broadcast(materialize(known, "known"), 40), "cls")
    senders = materialize(senders.groupBy("cls", "id").agg(F.min("doc_id").alias("doc_id")), "senders")
    anonymous = senders.where("doc_id is null").select("cls", "id")
    named = senders.where("doc_id is not null")
    texts_of = narrow.join(maybe_broadcast(named.select("doc_id").distinct(), 16), "doc_id", "left_semi")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            columns = pa.array(docs, pa.int64()), pa.array(ids, pa.binary()), pa.array(sets, pa.binary())
            return pa.RecordBatch.from_arrays(list(columns), ["doc_id", "cls", "s"])

        for batch in batches:
            docs, ids, sets, waiting = [], [], [], 0
            for doc, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(texts(batch.column("text")), words), strict=True):
                if not len(s):
                    continue
                docs.append(doc)
                ids.append(class_id(s))
                sets.append(s.tobytes())
                waiting += len(sets[-1])
                if waiting > 16 << 20:
                    yield rows()
                    docs, ids, sets, waiting = [], [], [], 0
            if ids:
                yield rows()

    shape = "doc_id long, cls binary, s binary"
    sets = texts_of.select("doc_id", "text").mapInArrow(send, shape)
    sets = sets.join(maybe_broadcast(named, 60), ["cls", "doc_id"]).select("id", "s")
    if anonymous.head(1):
        more = narrow.where("doc_id is null").select("doc_id", "text").mapInArrow(send, shape)
        more = more.join(maybe_broadcast(anonymous, 40), "cls").select("id", "s")
        # classes of rows without id may be sent by each of them
        sets = sets.unionByName(more.groupBy("id").agg(F.first("s").alias("s")))
    return materialize(sets, "sets")


def verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a table) that link, by the overlap of their whole sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for ca, cb, sa, sb in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    a.append(ca)
                    b.append(cb)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    # only sets that a pair names are moved: the pairs come to the sets where they are few
    known = maybe_broadcast(pairs.select("a", "b"), 32)
    left = sets.select(F.col("id").alias("a"), F.col("s").alias("sa")).join(known, "a")
    right = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    right = right.join(maybe_broadcast(pairs.select("b").distinct(), 16), "b", "left_semi")
    both = left.join(right, "b").select("a", "b", "sa", "sb")
    return materialize(both.mapInArrow(compare, "a long, b long"), "links")


def _open(member: DataFrame, found: DataFrame) -> DataFrame:
    """Members (tok, id, component) of the long lists that are in more than one component."""
    at = member.join(components(found).withColumnRenamed("node", "id"), "id", "left")
    at = materialize(at.withColumn("component", F.coalesce("component", "id")), "members")
    split = at.groupBy("tok").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    split = materialize(split.where("lo < hi").select("tok"), "split")
    out = materialize(at.join(maybe_broadcast(split, 16), "tok"), "unsettled")
    discard(at, split)
    return out


def _hub_pairs(at: DataFrame, step: int) -> DataFrame:
    """Pairs of members outside of a list's largest component with HUBS of its members, drawn by hashes, so
    that the lists of a group draw the same ones."""
    largest = at.groupBy("tok", "component").agg(F.count("*").alias("m")).groupBy("tok")
    largest = largest.agg(F.max_by("component", F.struct("m", "component")).alias("big"))
    marked = materialize(at.join(largest, "tok"), "marked")
    drawn = [F.min_by("id", F.xxhash64("id", F.lit(step * HUBS + k))) for k in range(HUBS)]
    hubs = marked.where("component = big").groupBy("tok").agg(F.array_distinct(F.array(*drawn)).alias("h"))
    pairs = marked.where("component <> big").join(hubs, "tok").select("id", F.explode("h").alias("h"))
    return pairs.select(F.least("id", "h").alias("a"), F.greatest("id", "h").alias("b")).distinct()


def _tile_pairs(at: DataFrame, classes: DataFrame, percent: int, nearest: int = 0) -> DataFrame:
    """Pairs of members of a list in different components that the signatures and sizes let link; with ``nearest``
    only those of each member with so many members whose signatures are the least apart from its own.

    Lists of nearly the same members are compared as one: a list's key is the least of its members' hashes,
    and all members of the lists of a key make a group. A pair is given by the first group that both are in. A
    group of more than TILE members is cut into parts, each pair of which is a tile of its own."""
    keys = at.groupBy("tok").agg(F.min(F.xxhash64("id")).alias("key"))
    grouped = materialize(at.join(keys, "tok").select("key", "id", "component").distinct(), "grouped")
    mine = grouped.groupBy("id", "component").agg(F.sort_array(F.collect_list("key")).alias("keys"))  # bounded by the prefix
    about = materialize(mine.join(classes.select("id", "n", "sig"), "id"), "about")
    cut = grouped.groupBy("key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("g")).where("g > 1")
    rows = grouped.select("key", "id").join(maybe_broadcast(materialize(cut, "cut"), 16), "key", "left")
    g = F.coalesce("g", F.lit(1))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("id", F.lit(1)), g).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), g - 1)))
    tile = F.least("mine", "other") * F.lit(1 << 20) + F.greatest("mine", "other")
    rows = rows.select("key", tile.alias("tile"), "mine", "id").join(about, "id")
    rows = rows.select("key", "tile", "mine", "id", "component", "n", "sig", "keys")
    parts = int(at.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "key", "tile").sortWithinPartitions("key", "tile")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != now:
                    if held:
                        yield from _tile(held, *now, percent, nearest)
                    now, held = row[:2], []
                held.append(row[2:])
        if held:
            yield from _tile(held, *now, percent, nearest)

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def _tile(rows: list, key: int, tile: int, percent: int, nearest: int = 0) -> Iterator[pa.RecordBatch]:
    """Pairs that may link within a tile of group ``key``, of members (part, id, component, n, sig, keys)."""
    across = tile >> 20 != tile & ((1 << 20) - 1)
    rows.sort(key=lambda r: len(r[4]))
    mine, ids, of, n = (np.array([r[k] for r in rows], np.int64) for k in range(4))
    width = np.array([len(r[4]) // 8 for r in rows])
    before = [frozenset(r[5][: bisect_left(r[5], key)]) for r in rows]
    for w in np.unique(width).tolist():
        # sets of linked classes differ in size by a third at most, so their signatures by one fold
        a = np.flatnonzero(width == w)
        b = np.flatnonzero((width == w) | (width == 2 * w))
        sa = np.stack([np.frombuffer(rows[k][4], np.uint64) for k in a])
        sb = np.stack([_folded(np.frombuffer(rows[k][4], np.uint64), w) for k in b])
        block = max(1, (1 << 20) // (len(b) * w))
        for k in range(0, len(a), block):
            x = a[k : k + block]
            may = of[x][:, None] != of[b][None, :]
            if not nearest:
                may &= x[:, None] < b[None, :]
            if across:
                may &= mine[x][:, None] != mine[b][None, :]
            if not may.any():
                continue
            apart = np.bitwise_count(sa[k : k + block][:, None, :] ^ sb[None, :, :]).sum(axis=2, dtype=np.int64)
            both = n[x][:, None] + n[b][None, :]
            may &= apart <= both - 2 * -(-percent * both // (100 + percent))
            if nearest and len(b) > nearest:
                apart[~may] = np.iinfo(np.int64).max
                may &= apart <= np.partition(apart, nearest - 1, axis=1)[:, nearest - 1 : nearest]
            i, j = np.nonzero(may)
            if nearest and len(i) > nearest * len(x):  # ties
                some = np.concatenate([np.flatnonzero(i == r)[:nearest] for r in range(len(x))])
                i, j = i[some], j[some]
            first = [bool(nearest) or before[p].isdisjoint(before[q]) for p, q in zip(x[i].tolist(), b[j].tolist(), strict=True)]
            if any(first):
                one, two = ids[x[i]][first], ids[b[j]][first]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], ["a", "b"])


def links(docs: DataFrame, doc_id: str, text_col: str, words: int = WORDS, percent: int = PERCENT):
    """(rows, classes, links): rows (doc_id, n, cls) of every document, the numbers (cls, id) of the classes, and
    verified links (a, b) of such numbers whose components are those of the full join."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = prefixes(narrow, sketch(narrow, words), words, percent)
    rows = table.where("slice is null").select("doc_id", "n", "cls")
    classes = table.where("id is not null").groupBy("cls").agg(F.min(F.struct("id", "n", "sig")).alias("c"))
    classes = materialize(classes.select("cls", "c.*"), "classes")
    met = meetings(shared_entries(table, classes), percent)
    tried = materialize(candidates(met), "tried")
    member = materialize(met.where("kind = 2").select("tok", F.col("a").alias("id")).distinct(), "listed")
    discard(met)

    def check(pairs: DataFrame, tested: bool = False) -> DataFrame:
        """The links among pairs."""
        pairs = pairs if tested else possible(pairs, classes, percent)  # tiles have tested theirs
        wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
        sets = whole_sets(narrow, table, classes, wanted, words)
        out = verified(sets, pairs, percent)
        discard(sets)
        return out

    found, before = check(tried), float("inf")
    tiles, near = False, 0
    for step in range(ROUNDS + NEAR_ROUNDS + 1):
        at = _open(member, found)
        sizes = at.groupBy("tok", "component").agg(F.count("*").alias("m")).groupBy("tok")
        open_ = F.pow(F.sum("m"), F.lit(2)) - F.sum(F.col("m") * F.col("m"))
        left, n = sizes.agg(open_.alias("p"), F.sum("m").alias("m")).agg(F.sum("p") / 2, F.sum("m")).first()
        if not n:
            break
        # hubs as long as they help; then each member's nearest ones, which joins most of what links; then all pairs
        tiles, before = tiles or step >= ROUNDS or left <= OPEN_PAIRS * n or 2 * left > before, left
        last = near == NEAR_ROUNDS
        more = _tile_pairs(at, classes, percent, 0 if last else NEAREST) if tiles else _hub_pairs(at, step)
        more = materialize(more.join(tried, ["a", "b"], "left_anti"), "more")
        found = found.unionByName(check(more, tested=tiles))
        discard(at)
        if last:
            break
        near += tiles
        tried = tried.unionByName(more)
    return rows, classes.select("cls", "id"), found


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id of its component)."""
    rows, classes, found = links(docs, doc_id, text_col, words, percent)
    # what is linked goes by the class of the least number, all else by its own
    parts = components(found).join(classes.withColumnRenamed("id", "node"), "node").select("cls", "component")
    name = classes.select(F.col("id").alias("component"), F.col("cls").alias("whole"))
    at = rows.join(parts.join(name, "component").select("cls", "whole"), "cls", "left")
    at = at.withColumn("component", F.coalesce("whole", "cls"))
    first = at.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("first"))
    return at.join(first, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("first", "doc_id").alias("component_id")
    )
