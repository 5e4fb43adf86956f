"""Shared helpers: tables, stored intermediate results, row keys, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import pathlib
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# A slice of a batch that is turned into numpy arrays at once.
SLICE_BYTES = 1 << 20
# Bits of the fixed-size filters below; their size never follows the data.
FILTER_BITS = 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder; the JVM removes it when it ends."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = f"{tempfile.gettempdir()}/checkpoints"
    folder = f"{base.rstrip('/')}/sozmill-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared folder, and read back.

    Cuts the lineage; lost executors lose nothing of it.
    """
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a binary column that hold about ``limit`` bytes, one row at least."""
    if not len(column):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield start, stop
        start = stop


def as_bytes(column: pa.Array) -> pa.Array:
    """A string column as UTF-8 bytes; null is empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def filter_bits(hashes: DataFrame, column: str) -> np.ndarray:
    """Fixed-size bit table of the values of ``column``: a filter without false negatives.

    Built by a grouped ``bit_or``, so at most ``2 ** (FILTER_BITS - 6)`` rows
    of 64 bits reach the driver, whatever the number of values.
    """
    bit = F.col(column).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    rows = (
        hashes.select(F.shiftright(bit, 6).alias("word"),
                      F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bits"))
        .groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()
    )
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for row in rows:
        out[row.word] = row.bits
    return out


def in_filter(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit ``values`` may be in the filter."""
    at = values.astype(np.int64) & ((1 << FILTER_BITS) - 1)
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def lean(run):
    """``run`` for ``mapInArrow``, giving memory back when its task ends.

    An executor keeps its Python workers for later tasks, and what they hold
    counts against its memory.
    """
    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)

    return wrapped


def with_fields(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df`` and more fields."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])


#: Bytes of an Arrow batch, where the session has Spark's own setting of 64 MB.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark context, and bound Arrow batches by bytes.

    Not needed where the package is installed on all machines and the session
    bounds its batches.
    """
    if spark.conf.get(BATCH[0], "64m") in ("64m", "67108864b", "67108864"):
        spark.conf.set(*BATCH)
    context = spark.sparkContext
    name = f"sozmill-{context.applicationId}"
    if any(name in path for path in sys.path):
        return
    root = pathlib.Path(__file__).resolve().parents[2]
    archive = pathlib.Path(tempfile.mkdtemp()) / f"{name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted((root / "sozmill").rglob("*.py")):
            out.write(path, path.relative_to(root))
    context.addPyFile(str(archive))


def in_bits(values: DataFrame, column: str):
    """A function of a 64-bit column: may its value be in ``values``? By a filter of fixed size."""
    shared = values.sparkSession.sparkContext.broadcast(filter_bits(values.select(column), column))

    @F.arrow_udf("boolean")
    def maybe(keys: pa.Array) -> pa.Array:
        return pa.array(in_filter(shared.value, keys.to_numpy()))

    return maybe


def without(docs: DataFrame, key: Column, gone: DataFrame, once: DataFrame | None = None) -> DataFrame:
    """Rows of ``docs`` whose 64-bit key is not in ``gone``, a stored table with a column ``key``.

    Of the rows with a key in ``once`` a single one stays. Rows that a filter of
    fixed size clears pass as they are; only the others are shuffled.
    """
    touched = gone.select("key") if once is None else gone.select("key").unionByName(once.select("key"))
    maybe = in_bits(touched, "key")
    keyed = docs.withColumn("__key", key)
    rest = keyed.filter(maybe("__key")).join(
        gone.select(F.col("key").alias("__key")).distinct(), "__key", "left_anti")
    if once is not None:
        rest = rest.dropDuplicates(["__key"])
    return keyed.filter(~maybe("__key")).unionByName(rest).drop("__key")
