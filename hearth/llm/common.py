"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import pickle
import sys
import types
import uuid
import zlib
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` words after lower-casing A-Z:
#: digits, a-z and every byte of a non-ASCII character stay, the rest splits.
WORD_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_words(data: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text (``WORD_TABLE``)."""
    return data.translate(WORD_TABLE).split()


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would change other letters too)."""
    return F.translate(c, UPPER, LOWER)


def id_crc32(c: Column) -> Column:
    """Unsigned crc32 of an id's decimal text (null for a null id)."""
    return F.crc32(c.cast("string").cast("binary"))


def binaries(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, None for nulls."""
    return column.cast(pa.binary()).to_pylist()


def ensure_checkpoints(spark: SparkSession) -> None:
    """Point ``checkpoint()`` at the shared folder the cluster names in
    ``spark.checkpoint.dir`` (a scratch folder only where that is unset)."""
    from hearth.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    # plans that hold a literal map or many joins would fill the driver with their texts
    spark.conf.set("spark.sql.maxPlanStringLength", PLAN_CHARS)


def release(spark: SparkSession) -> None:
    """Let go of finished shuffles: Spark deletes their files once the driver's JVM
    has collected what refers to them, which may otherwise take many stages."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder now and go on from
    there: the lineage is cut, a lost executor loses nothing, and a compressed
    table takes a fraction of a checkpoint's bytes."""
    spark = df.sparkSession
    ensure_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/staged-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def _is_scan(docs: DataFrame) -> bool:
    """Whether a row of ``docs`` is one row of one Parquet file, so that file and number
    tell it from all others: a file relation under projections and filters only (no
    generator, union, join or sample), without a file read twice or a column of the
    files that hides their metadata."""
    plan = docs._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.getClass().getSimpleName() != "LogicalRelation" or plan.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return False
    roots = plan.relation().location().rootPaths()
    paths = [roots.apply(i).toString().rstrip("/") + "/" for i in range(roots.size())]
    if any(a != b and a.startswith(b) for a in paths for b in paths) or len(set(paths)) < len(paths):
        return False
    return "_metadata" not in {n.lower() for n in plan.relation().dataSchema().names()}


def located(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows have a place of their own in Parquet files, else a staged
    copy (a column then must not be named ``_metadata``: take the needed columns or
    ``renamed`` ones first). An operator that keys its rows more than once takes this
    first, once."""
    return docs if _is_scan(docs) else staged(docs)


def renamed(docs: DataFrame) -> DataFrame:
    """``docs`` with columns ``c0, c1, ...``, which clash with nothing."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def column(docs: DataFrame, name: str) -> str:
    """The name that column ``name`` of ``docs`` has in ``renamed(docs)``."""
    return f"c{[c.lower() for c in docs.columns].index(name)}"


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (see ``located``) plus ``__k1, __k2``: a key of the physical row that
    is the same in every scan and after a lost executor, namely the Parquet file and
    the row number in it."""
    return docs.select("*", F.xxhash64(F.col("_metadata.file_path")).alias("__k1"),
                       F.col("_metadata.row_index").alias("__k2"))


#: Longest text of a plan that the driver makes for its listeners.
PLAN_CHARS = 8192
#: Rows of one Arrow batch. Whole texts are wide rows: the default of 10,000 would
#: hold tens of megabytes of text at a time in every Python worker.
BATCH_ROWS = 1000
BATCH_BYTES = 32 * 1024 * 1024


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of at most ``BATCH_ROWS`` rows and about
    ``BATCH_BYTES`` (sets the session's limits)."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(fn, schema)


def append_columns(df: DataFrame, fields: list[T.StructField],
                   fn: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, list[pa.Array]]]]) -> DataFrame:
    """``df`` plus ``fields`` computed by ``fn`` over Arrow batches. ``fn`` yields
    each input batch once, in order, with the new arrays. Input columns pass
    through untouched under internal names, so clashing names are no matter."""
    inner = renamed(df)
    names = inner.columns + [f"r{i}" for i in range(len(fields))]
    schema = T.StructType([*inner.schema.fields, *(T.StructField(f"r{i}", f.dataType, True) for i, f in enumerate(fields))])

    def run(batches):
        for batch, arrays in fn(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=names)

    return map_batches(inner, run, schema).toDF(*df.columns, *[f.name for f in fields])


def in_worker(key: str, make: Callable[[], object]) -> object:
    """``make()``, kept by the Python worker from task to task; a worker holds the
    latest one only. For memos of bounded size that are no part of the result."""
    held = sys.modules.setdefault("_llm_worker", types.ModuleType("_llm_worker")).__dict__
    if held.get("key") != key:
        held.update(key=key, value=make())
    return held["value"]


class Shipped:
    """An object of bounded size sent to the executors once, compressed (tables of
    fixed size are mostly empty on small inputs). Its class travels by value too,
    which a plain broadcast would not do. ``key`` names the value."""

    def __init__(self, spark: SparkSession, value: object):
        data = cloudpickle.dumps(value)
        self.key = sha256(data).hexdigest()
        self._sent = spark.sparkContext.broadcast(zlib.compress(data, 1))

    def get(self):
        return pickle.loads(zlib.decompress(self._sent.value))
