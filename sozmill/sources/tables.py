"""Labelled tables in, canonical rows out.

Canonical columns: ``source``, ``source_ord``, ``row_ord``, ``text`` and the
label already mapped to ``sentiment_value`` by the scheme of its source.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.labels import SCHEMES, sentiment_value

# Columns that exports leave behind.
JUNK_COLUMNS = ("Unnamed: 0", "index")

CANONICAL = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("source_ord", T.IntegerType()),
        T.StructField("row_ord", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("has_label", T.BooleanType()),
        T.StructField("sentiment_value", T.DoubleType()),
    ]
)
READ_STATUS = "source string, status string, detail string"
#: Holds the whole record where a row of a text format can't be read.
CORRUPT = "__corrupt"
TEXT_FORMATS = ("csv", "json")


@dataclass(frozen=True)
class SourceSpec:
    """Where a labelled table is and how to read its label.

    ``order_col`` names a column that holds the row order. Without it the
    order in the files is used. ``options`` are the reader's; ``schema`` among them
    is the schema, which spares inferring it.
    """

    name: str
    path: str | None = None
    text_col: str = "text"
    label_col: str | None = "label"
    scheme: str = "binary"
    fmt: str = "parquet"
    options: dict = field(default_factory=dict)
    order_col: str | None = None

    def __post_init__(self):
        if self.label_col is not None and self.scheme not in SCHEMES:
            raise ValueError(f"unknown label scheme {self.scheme!r}")


# The five tables of the original configuration.
DEFAULT_SOURCES = (
    SourceSpec("labeled-sentiment", "labeled-sentiment", "text", "sentiment", "tri"),
    SourceSpec("test__1_", "test__1_", "text", "label", "binary"),
    SourceSpec("train__3_", "train__3_", "text", "label", "binary"),
    SourceSpec("train-00000-of-00001", "train-00000-of-00001", "text", "labels", "tri"),
    SourceSpec("merged_dataset_CSV__1_", "merged_dataset_CSV__1_", "text", "labels", "binary"),
)


def read_table(spark: SparkSession, spec: SourceSpec) -> DataFrame | None:
    """The raw table, or None if there is nothing at its path.

    Tables of text formats have a column ``CORRUPT``: null, or the record that isn't
    as the others are, such as a CSV row with another number of fields.
    """
    options = {k: v for k, v in spec.options.items() if k != "schema"}
    reader = spark.read.format(spec.fmt).options(**options)
    try:
        df = (reader.schema(spec.options["schema"]) if "schema" in spec.options else reader).load(spec.path)
        if "schema" in spec.options and spec.fmt in TEXT_FORMATS:
            df.inputFiles()  # with a schema Spark looks for the files only now
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise
    if spec.fmt not in TEXT_FORMATS:
        return df
    # All fields must be parsed, else a bad one that isn't asked for goes unseen.
    fields = [f for f in df.schema if f.name != "_corrupt_record"]
    return spark.read.format(spec.fmt).options(**options).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False,
    ).schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])).load(spec.path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Readable rows, and the records that aren't; None for formats that have none."""
    if CORRUPT not in df.columns:
        return df, None
    # Spark wants more than that column to be read.
    others = F.array(*[F.col(f"`{c}`").isNull() for c in df.columns if c != CORRUPT])
    bad = df.filter(F.col(CORRUPT).isNotNull() & (F.size(others) >= 0))
    return df.filter(F.col(CORRUPT).isNull() & (F.size(others) >= 0)), bad


def with_row_order(df: DataFrame, name: str = "row_ord", fmt: str = "parquet") -> DataFrame:
    """Number the rows of a file-backed table in file order.

    Parquet knows the place of a row in its file; other formats are numbered
    inside each split as they are read. Rows are counted for each file or
    split, and that small table gives the offsets: sums inside ranges of files,
    and over the ranges. There is no sort and no shuffle of the rows, and no
    task sees all files.
    """
    if fmt == "parquet":
        keys, place = ["__file"], F.col("_metadata.row_index")
    else:
        keys, place = ["__file", "__block"], F.monotonically_increasing_id()
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        place.alias("__place"),
    )
    counts = placed.groupBy(*keys).agg(
        F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    # Stored, so that the ranges are cut once.
    ranged = materialize(counts.repartitionByRange(*keys).withColumn("__range", F.spark_partition_id()))
    inside = Window.partitionBy("__range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range, of which there are as many as shuffle partitions.
    ranges = ranged.groupBy("__range").agg(F.sum("__rows").alias("__rows"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    offsets = ranged.withColumn("__inside", F.coalesce(F.sum("__rows").over(inside), F.lit(0))).join(
        starts, "__range").select(*keys, "__first", (F.col("__start") + F.col("__inside")).alias("__offset"))
    return placed.join(offsets, keys).withColumn(
        name, F.col("__offset") + F.col("__place") - F.col("__first")
    ).drop("__file", "__block", "__place", "__first", "__offset")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a scan that has too few pieces for them.

    A Parquet row group is read by one task, so a file or two of text would be
    cleaned by one core. Only such small inputs are spread by a shuffle; a scan
    of at least one piece for each core is left alone, however large it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    sizes = df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).distinct()
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # Row groups are about as large as a block, so beyond this there are enough.
    return df.repartition(cores) if total < cores * (128 << 20) else df


def missing_columns(df: DataFrame, spec: SourceSpec) -> list[str]:
    wanted = [c for c in (spec.text_col, spec.label_col) if c is not None]
    return [c for c in wanted if c not in df.columns]


def _present(value: Column, data_type: T.DataType) -> Column:
    """Not missing, in the sense that NaN is missing too."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def canonical(df: DataFrame, spec: SourceSpec, source_ord: int = 0) -> DataFrame:
    """Project a raw table to the canonical columns; only these are read."""
    df, _ = split_corrupt(df.drop(*JUNK_COLUMNS))
    if spec.order_col is None:
        df = with_row_order(df, "__row_ord", spec.fmt)
        order = F.col("__row_ord")
    else:
        order = F.col(f"`{spec.order_col}`")
    text, text_type = F.col(f"`{spec.text_col}`"), df.schema[spec.text_col].dataType
    if spec.label_col is None:
        has_label, value = F.lit(False), F.lit(None)
    else:
        label, label_type = F.col(f"`{spec.label_col}`"), df.schema[spec.label_col].dataType
        has_label = _present(label, label_type)
        value = sentiment_value(label, spec.scheme, label_type)
    return df.select(
        F.lit(spec.name).alias("source"),
        F.lit(source_ord).alias("source_ord"),
        order.cast("long").alias("row_ord"),
        F.when(_present(text, text_type), text.cast("string")).alias("text"),
        has_label.alias("has_label"),
        value.cast("double").alias("sentiment_value"),
    )


def read_sources(spark: SparkSession, specs) -> tuple[DataFrame, DataFrame]:
    """Union of all readable sources in list order, and one status row each.

    A missing table or column skips that source, as its status row says; any
    other failure is raised. Rows that can't be read are left out and counted in
    ``bad_rows`` of the status, when that is computed; so no row is lost unreported.
    """
    parts, status, bad = [], [], []
    for source_ord, spec in enumerate(specs):
        raw = read_table(spark, spec)
        if raw is None:
            status.append((spec.name, "missing", f"nothing at {spec.path}"))
            continue
        lacking = missing_columns(raw, spec)
        if lacking:
            status.append((spec.name, "no columns", ", ".join(lacking)))
            continue
        status.append((spec.name, "read", ""))
        parts.append(canonical(raw, spec, source_ord))
        corrupt = split_corrupt(raw)[1]
        if corrupt is not None:
            bad.append(corrupt.select(F.lit(spec.name).alias("source")))
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], CANONICAL)
    said = spark.createDataFrame(status, READ_STATUS)
    if not bad:
        return rows, said.withColumn("bad_rows", F.lit(0).cast("long"))
    counts = reduce(DataFrame.unionByName, bad).groupBy("source").agg(F.count(F.lit(1)).alias("bad_rows"))
    return rows, said.join(counts, "source", "left").fillna(0, ["bad_rows"])


def bad_records(spark: SparkSession, specs) -> DataFrame:
    """The records themselves that can't be read: ``source, record``."""
    parts = [spark.createDataFrame([], "source string, record string")]
    for spec in specs:
        raw = read_table(spark, spec)
        corrupt = None if raw is None else split_corrupt(raw)[1]
        if corrupt is not None:
            parts.append(corrupt.select(F.lit(spec.name).alias("source"), F.col(CORRUPT).alias("record")))
    return reduce(DataFrame.unionByName, parts)


def read_cleaned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Only the columns that training and evaluation use."""
    df = spark.read.format(fmt).load(path)
    extra = [c for c in ("source", "source_ord", "row_ord", "domain") if c in df.columns]
    return df.select(*extra, "cleaned_text")


def read_corpus(spark: SparkSession, path: str, domain: str | None = None) -> DataFrame:
    """Corpus lines as ``value``, with their ``domain`` if they were written by domain.

    With a ``domain`` only its folder is listed and read.
    """
    df = spark.read.text(path)
    if domain is None:
        return df
    if "domain" not in df.columns:
        return df.filter(F.col("value").startswith(f"dom{domain} "))
    return df.filter(F.col("domain") == domain)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder for checkpoints that all executors share; one is chosen here only in local mode."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = f"{tempfile.gettempdir()}/checkpoints"
    return folder


def work_folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder; it is removed when the session's JVM ends."""
    folder = f"{checkpoint_folder(spark).rstrip('/')}/work-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage.

    Goes to the reliable checkpoint folder of the session, so the result
    outlives lost executors.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint()


def require_rows(df: DataFrame, what: str = "sentences") -> DataFrame:
    """``df`` itself; raises if it has no row."""
    if df.isEmpty():
        raise RuntimeError(f"No {what} found. Build the clean tables first.")
    return df
