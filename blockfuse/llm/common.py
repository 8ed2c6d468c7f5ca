"""Helpers shared by the corpus operators: work tables, Arrow text access, size-checked broadcasts."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A side is broadcast only if its counted rows times this estimate stay below the bound.
BROADCAST_BYTES = 32 << 20

_work: dict[str, tuple[SparkSession, str]] = {}
_scope = ["operator"]


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; where it is unset
    (tests on one machine) a temporary one is made and set as checkpoint folder."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("blockfuse.work.dir", None)
    if not found and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="blockfuse-")
        spark.conf.set("blockfuse.work.dir", found)
        sc.setCheckpointDir(found)
        _work[found] = (spark, "folder")
    return found


def materialize(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet (with the writer's ``options``) in the shared folder and read it back: cuts the
    lineage, survives the loss of executors, and keeps column pruning for later readers."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/blockfuse-work/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").options(**(options or {})).parquet(path)
    _work[path] = (spark, _scope[-1])
    out = spark.read.schema(df.schema).parquet(path)
    out._work_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete work tables (as ``materialize`` returned them) whose last reader has run."""
    for df in tables:
        spark, _ = _work.pop(df._work_path)
        _delete(spark, df._work_path)


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session has ended
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def work_scope(name: str):
    """Work tables written meanwhile belong to ``name``, and can be released by it."""
    _scope.append(name)
    try:
        yield
    finally:
        _scope.pop()


def release(spark: SparkSession, scope: str | None = None) -> None:
    """Delete the work tables of a scope (None: all). Call it only when no result that reads them is
    still to be computed (the pipeline does so once a stage's output has been written)."""
    for path in [p for p, (s, at) in _work.items() if s is spark and scope in (None, at)]:
        del _work[path]
        _delete(spark, path)


@atexit.register
def _at_exit() -> None:
    for spark in list({id(s): s for s, _ in _work.values()}.values()):
        release(spark)


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of rows on the driver. It goes by Arrow: a list would go through an RDD, for which each executor
    starts Python workers of another environment than those of its other stages, and keeps them."""
    fields = T.StructType.fromDDL(schema)
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(fields.names, r, strict=True)) for r in rows], to_arrow_schema(fields)), fields)


def with_row_numbers(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column of distinct longs that stay the same whenever it is read: file and place in the
    file where it is a scan of Parquet files; else it is written with numbers."""
    spark = docs.sparkSession
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    at = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    files = sorted(r[0] for r in docs.select(at[0].alias("f")).distinct().collect())  # one row a file
    number = local_table(spark, [(f, k << 40) for k, f in enumerate(files)], "__f string, __n long")
    out = docs.select("*", at[0].alias("__file"), at[1].alias("__at"))
    out = out.join(maybe_broadcast(number, 200), F.col("__file") == F.col("__f"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], (F.col("__n") + F.col("__at")).alias(name))


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` (cheap to count: a work table) may be broadcast."""
    return df.count() * row_bytes <= limit


def maybe_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """A broadcast hint behind a check of the size; beyond it the join shuffles."""
    return F.broadcast(df) if small(df, row_bytes) else df


#: Bytes of text that a fitting sample may bring to the driver.
SAMPLE_BYTES = 64 << 20


def sampled(rows: DataFrame, text: str, n: int, most_bytes: int = SAMPLE_BYTES, labels: DataFrame | None = None, key: str = "") -> list:
    """Rows to fit a model on, on the driver: one for each distinct text, in order of the texts' hashes, at most
    ``n`` and with texts of at most ``most_bytes`` in all (a text that no longer fits is passed over).

    With ``labels``, rows (key, label 0 or 1), that is for each of the two labels, a text having its largest, and the
    rows are (text, label). Only hashes and sizes meet the labels; no text is shuffled but those chosen."""
    hashed = rows.where(F.col(text).isNotNull()).withColumn("__h", F.xxhash64(text))
    narrow = hashed.select("__h", F.octet_length(text).alias("size"), *([key] if key else []))
    narrow = narrow.withColumn("label", F.lit(0)) if labels is None else narrow.join(labels, key)
    sizes = narrow.groupBy("__h").agg(F.max("size").alias("size"), F.max("label").alias("label"))
    chosen = []
    for y in (0,) if labels is None else (0, 1):
        left = most_bytes
        for h, size, _ in sizes.where(F.col("label") == y).orderBy("__h").limit(n).collect():  # n rows of numbers
            if size <= left:
                chosen.append((h, y))
                left -= size
    if not chosen:
        return []
    chosen = local_table(rows.sparkSession, chosen, "__h long, __y int")
    if labels is not None:
        hashed = hashed.select(text, "__h")
    found = hashed.join(F.broadcast(chosen), "__h").dropDuplicates(["__h"]).orderBy("__h")
    return (found.select(text, "__y") if labels is not None else found.drop("__h", "__y")).collect()


def texts(column: pa.Array) -> Iterator[bytes | None]:
    """UTF-8 bytes of each row of a string column, one at a time (None for null)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    data = memoryview(buffers[2]) if buffers[2] is not None else memoryview(b"")
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for k in range(len(column)):
        yield data[offsets[k] : offsets[k + 1]].tobytes() if valid[k] else None


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package wherever they are started from."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
