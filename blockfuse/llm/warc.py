"""WARC archives with a two-level capture index.

Writing. Every page is one WARC/1.1 record, a gzip member of its own. Of pages with equal payloads the
one with the largest id is a ``response`` with the payload, all others are ``revisit`` records that name
its record and digest. Members are packed into archive chunks of about ``CHUNK`` bytes; a chunk is one row
(archive, start, end, data) of the archive table, which Spark writes to any store it can write to, with
its commit protocol; ``export`` joins chunks into .warc.gz files. (Spark has no sink for raw binary files,
and a file written by a task itself would neither be committed nor reach a store other than a mount.)

Index. Entries (key, archive, offset, length, ...) are range-sorted by key: the URL's host labels in
reverse order, then the rest of the URL. Each ``BLOCK`` entries become one zlib-compressed block; the
sparse directory holds the first key and the number of each block. ``lookup`` searches the directory
binarily for the blocks of the wanted keys, the block for the key, and then reads the ranges of the
archive that the entries name. A lookup of few keys names its blocks and chunks to the scans, which
then read the pages of those rows alone (the tables are written in their order, in small pages); one of many
joins them.

Digests: base-32 SHA-1 of the full payload, for revisits too.

Defined cases: a null html is the empty payload, and empty payloads are equal to each other; null URLs
have the key ')'. Of rows of equal id and equal payload that would be the response, all are. Rows
without id are never the response if one with an id has the payload. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, maybe_broadcast, texts

CHUNK = 1 << 20
BLOCK = 1000
DATE = "1970-01-01T00:00:00Z"
_NO_ID = -(1 << 63)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Reversed host labels, then ')' and the rest of the URL: 'http://a.b.org/x' -> 'org,b,a)/x'."""
    m = re.match(r"(?s).*?://([^/?#]*)(.*)$", url or "")
    if not m:
        return ")" + (url or "")
    return ",".join(reversed(m[1].lower().split("."))) + ")" + m[2]


def record(kind: str, page_id, url: str | None, payload: bytes, payload_digest: str, size: int, refers_to) -> bytes:
    """One record as a gzip member."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    body = payload if kind == "response" else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"X-Payload-Length: {size}",
        f"Content-Length: {len(body)}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in url))
    if kind == "revisit":
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parse(member: bytes) -> dict:
    """Fields of a record: type, page_id, refers_to, url, payload (None for a revisit), digest, size. The
    digest of a stored payload is computed anew; one that differs from the header is an error."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    field = dict(x.split(": ", 1) for x in lines[1:])
    number = lambda x: int(x[10:-1]) if x and x[10:-1] else None
    body = rest[: int(field["Content-Length"])]
    told = field["WARC-Payload-Digest"][5:]
    out = {
        "type": field["WARC-Type"],
        "page_id": number(field["WARC-Record-ID"]),
        "refers_to": number(field.get("WARC-Refers-To")),
        "url": field.get("WARC-Target-URI"),
        "payload": body if field["WARC-Type"] == "response" else None,
        "digest": told,
        "size": int(field["X-Payload-Length"]),
    }
    if out["payload"] is not None and (digest(body) != told or len(body) != out["size"]):
        raise ValueError(f"the payload of {field['WARC-Record-ID']} is damaged")
    return out


def plan_records(pages: DataFrame, page_id: str, html_col: str) -> DataFrame:
    """Rows (k, sha1, refers_to): the (id, payload) pairs that are revisits, one row for each."""
    k = F.coalesce(F.col(page_id).cast("long"), F.lit(_NO_ID)).alias("k")
    found = pages.select(k, _sha1(F.col(html_col)).alias("sha1")).distinct()
    found = materialize(found, "digests")
    last = materialize(found.groupBy("sha1").agg(F.max("k").alias("refers_to"), F.count("*").alias("n")).where("n > 1"), "repeats")
    joined = found.join(maybe_broadcast(last, 120), "sha1")
    return joined.where("k < refers_to").select("k", "sha1", "refers_to")


def _sha1(html) -> F.Column:
    return F.sha1(F.coalesce(html.cast("string"), F.lit("")).cast("binary"))


_ARCHIVE = "archive string, start long, end long, data binary, entries array<struct<key:string,offset:long,length:int,page_id:long>>"


#: Blocks or chunks that a scan is told by name, at most (Parquet's filter tells so many values apart).
MOST_NAMED = 10


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A work table whose pages and row groups hold few rows, so that a filter skips the others."""
    return materialize(df, name, {"parquet.page.row.count.limit": "1", "parquet.block.size": str(8 * CHUNK)})


def _named(table: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``table`` without the rows that no wanted row (a work table of keys) names, where these are few."""
    few = wanted.select(*keys).distinct().limit(MOST_NAMED + 1).collect()
    if len(few) > MOST_NAMED:
        return table
    for c in keys:
        table = table.where(F.col(c).isin(*{r[c] for r in few}))
    return table


def write_archives(
    pages: DataFrame, page_id: str = "page_id", url_col: str = "url", html_col: str = "html", chunk: int = CHUNK
) -> DataFrame:
    """The archive table (archive, start, end, data, entries), written to the shared folder: one archive for
    each task, its chunks in order of ``start``; ``entries`` says where the chunk's records are."""
    again = materialize(plan_records(pages, page_id, html_col), "revisits")
    rows = pages.select(
        F.coalesce(F.col(page_id).cast("long"), F.lit(_NO_ID)).alias("k"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    # an id has one payload as a rule; where it has several (or rows have none), the digest tells which row is meant
    rows = rows.withColumn("sha1", _sha1(F.col("html"))).join(maybe_broadcast(again, 100), ["k", "sha1"], "left")
    entry = pa.struct([("key", pa.string()), ("offset", pa.int64()), ("length", pa.int32()), ("page_id", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = f"part-{TaskContext.get().partitionId():06d}"
        start, held, entries = 0, bytearray(), []

        def flush():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([archive]),
                    pa.array([start], pa.int64()),
                    pa.array([start + len(held)], pa.int64()),
                    pa.array([bytes(held)], pa.binary()),
                    pa.array([entries], pa.list_(entry)),
                ],
                ["archive", "start", "end", "data", "entries"],
            )

        for batch in batches:
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)), batch.column(3).to_pylist()
            for k, url, html, of in zip(*columns, strict=True):
                payload, number = html or b"", None if k == _NO_ID else k
                told = digest(payload)
                kind = "response" if of is None else "revisit"
                member = record(kind, number, url, payload, told, len(payload), of)
                entries.append({"key": url_key(url), "offset": start + len(held), "length": len(member), "page_id": number})
                held += member
                if len(held) >= chunk:
                    yield flush()
                    start, held, entries = start + len(held), bytearray(), []
        if held:
            yield flush()

    return _stored(rows.select("k", "url", "html", "refers_to").mapInArrow(write, _ARCHIVE), "archives")


def _escaped(key: str) -> str:
    """A key on one line; '%' too is escaped, so that a '%0A' of the URL itself comes back as it was."""
    return key.replace("%", "%25").replace("\n", "%0A")


def _unescaped(key: str) -> str:
    return key.replace("%0A", "\n").replace("%25", "%")


def build_index(archives: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(blocks, directory): blocks (block, first, last, n, data) of sorted entry lines, and the sparse
    directory (first, last, block), both in the shared folder."""
    lines = archives.select("archive", F.explode("entries").alias("e")).select("e.*", "archive")
    parts = max(1, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = lines.select("key", "archive", "offset", "length").repartitionByRange(parts, "key", "archive", "offset")
    ordered = ordered.sortWithinPartitions("key", "archive", "offset")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial, held = TaskContext.get().partitionId() << 32, []

        def flush():
            text = "\n".join(f"{_escaped(k)}\t{a}\t{o}\t{n}" for k, a, o, n in held)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([serial], pa.int64()),
                    pa.array([held[0][0]]),
                    pa.array([held[-1][0]]),
                    pa.array([len(held)], pa.int32()),
                    pa.array([zlib.compress(text.encode(), 6)], pa.binary()),
                ],
                ["block", "first", "last", "n", "data"],
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                if len(held) >= block:
                    yield flush()
                    serial, held = serial + 1, []
        if held:
            yield flush()

    shape = "block long, first string, last string, n int, data binary"
    blocks = _stored(ordered.mapInArrow(pack, shape), "blocks")
    return blocks, blocks.select("first", "last", "block")


def _entries(data: bytes) -> list[tuple]:
    out = []
    for line in zlib.decompress(data).decode().split("\n"):
        key, archive, offset, length = line.rsplit("\t", 3)
        out.append((_unescaped(key), archive, int(offset), int(length)))
    return out


#: Directory rows that are shipped to the tasks; a larger directory is joined by range instead.
MOST_DIRECTORY = 200_000


def locate(blocks: DataFrame, directory: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows (key, archive, offset, length) of the wanted keys (column key)."""
    wanted = keys.select("key").distinct()
    spark = keys.sparkSession
    if directory.count() <= MOST_DIRECTORY:
        rows = sorted((r[0], r[1], r[2]) for r in directory.toLocalIterator())
        shipped = spark.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first, last, number = shipped.value
            for batch in batches:
                keys_, blocks_ = [], []
                for key in batch.column(0).to_pylist():
                    # from the first block that may hold the key: the one before those that begin at or after it
                    k = max(0, bisect.bisect_left(first, key) - 1)
                    while k < len(first) and first[k] <= key:
                        if key <= last[k]:
                            keys_.append(key)
                            blocks_.append(number[k])
                        k += 1
                yield pa.RecordBatch.from_arrays([pa.array(keys_, pa.string()), pa.array(blocks_, pa.int64())], ["key", "block"])

        at = wanted.mapInArrow(search, "key string, block long")
    else:
        at = _range_join(wanted, directory)
    at = materialize(at.groupBy("block").agg(F.sort_array(F.collect_set("key")).alias("wanted")), "wanted")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, want in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = _entries(data)
                names = [r[0] for r in rows]
                for key in want:
                    k = bisect.bisect_left(names, key)
                    while k < len(rows) and names[k] == key:
                        out.append(rows[k])
                        k += 1
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            kinds = pa.string(), pa.string(), pa.int64(), pa.int32()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["key", "archive", "offset", "length"]
            )

    found = _named(blocks, at, ["block"]).select("block", "data").join(at, "block").select("data", "wanted")
    return found.mapInArrow(read, "key string, archive string, offset long, length int")


def _range_join(wanted: DataFrame, directory: DataFrame) -> DataFrame:
    """(key, block) for keys within [first, last], without shipping the directory: keys and block
    beginnings are put in one order, and the last beginnings before a key are found in ranges."""
    parts = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = directory.sample(False, min(1.0, 50 * parts / max(1, directory.count())), 1).select("first").orderBy("first")
    rows = [r[0] for r in cuts.limit(100 * parts).collect()][:: max(1, 50)]
    cell = lambda c: F.size(F.filter(F.array(*[F.lit(x) for x in rows]).cast("array<string>"), lambda x: x <= c))
    d = directory.withColumn("lo", cell(F.col("first"))).withColumn("hi", cell(F.col("last")))
    d = d.withColumn("cell", F.explode(F.sequence("lo", "hi")))
    w = wanted.withColumn("cell", cell(F.col("key")))
    return w.join(d, "cell").where("first <= key and key <= last").select("key", "block")


_READ = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def read_records(archives: DataFrame, places: DataFrame, payloads: bool = False) -> DataFrame:
    """The records at places (archive, offset, length), read by range. ``payloads``: with the stored
    payload (null for revisits)."""
    places = materialize(places, "places")
    spans = archives.select("archive", "start", "end")
    # a place lies in one chunk: chunks are found by the offsets at which they begin
    cells = F.explode(F.sequence(F.floor(F.col("start") / CHUNK), F.floor((F.col("end") - 1) / CHUNK))).alias("cell")
    spans = spans.select("archive", "start", "end", cells)
    at = places.withColumn("cell", F.floor(F.col("offset") / CHUNK)).join(spans, ["archive", "cell"])
    at = at.where("offset >= start and offset < end")
    # a chunk's places are bounded by the chunk
    at = at.groupBy("archive", "start").agg(F.sort_array(F.collect_set(F.struct("offset", "length"))).alias("places"))
    at = materialize(at, "chunks")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data, places in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True
            ):
                got = [parse(data[p["offset"] - start : p["offset"] - start + p["length"]]) for p in places]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([g["page_id"] for g in got], pa.int64()),
                        pa.array([g["url"] for g in got], pa.string()),
                        pa.array([g["type"] for g in got], pa.string()),
                        pa.array([g["digest"] for g in got], pa.string()),
                        pa.array([g["size"] for g in got], pa.int64()),
                        pa.array([g["refers_to"] for g in got], pa.int64()),
                        pa.array([g["payload"] if payloads else None for g in got], pa.binary()),
                    ],
                    ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"],
                )

    found = _named(archives, at, ["archive", "start"]).select("archive", "start", "data").join(at, ["archive", "start"]).select("start", "data", "places")
    return found.mapInArrow(read, _READ)


def lookup(archives: DataFrame, blocks: DataFrame, directory: DataFrame, urls: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of the wanted URLs (column url): directory, block, range read."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string())], ["key"])

    keys = urls.select(F.col("url").cast("string")).mapInArrow(key, "key string")
    return read_records(archives, locate(blocks, directory, keys), payloads)


def export(archives: DataFrame, folder: str) -> list[str]:
    """Join the chunks into .warc.gz files in a local folder (for archives that fit one machine)."""
    os.makedirs(folder, exist_ok=True)
    names = []
    for row in archives.select("archive", "start", "data").orderBy("archive", "start").toLocalIterator():
        path = os.path.join(folder, f"{row[0]}.warc.gz")
        with open(path, "ab" if row[1] else "wb") as f:
            f.write(row[2])
        names.append(path)
    return list(dict.fromkeys(names))


def read_file(path: str) -> list[dict]:
    """All records of a .warc.gz file, as another reader would see them: the gzip members in order."""
    out, data = [], open(path, "rb").read()
    while data:
        one = zlib.decompressobj(31)
        raw = one.decompress(data)
        out.append(parse(gzip.compress(raw)))
        data = one.unused_data
    return out


def round_trip(pages: DataFrame, page_id: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages, index them, look every URL up and read its records back by range."""
    archives = write_archives(pages, page_id, url_col, html_col)
    blocks, directory = build_index(archives)
    return lookup(archives, blocks, directory, pages.select(F.col(url_col).alias("url")))
