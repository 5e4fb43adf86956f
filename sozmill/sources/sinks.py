"""Clean tables and corpus text out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, functions as F


def write_two_column(df: DataFrame, path: str, fmt: str = "parquet", bare: bool = False) -> int:
    """Write ``(cleaned_text, sentiment_value)`` by source; return the row count.

    Only the sources in ``df`` are replaced, those of other runs stay; a repeated run
    changes nothing. The order and the domain of the rows go along, as training on a head and
    metrics by domain need them; ``bare`` leaves just the two columns. The rows
    are counted while they are written, so there is no second pass.
    """
    return _write_sources(df, path, fmt, bare, ())["rows"]


def write_sources(
    df: DataFrame, path: str, sources: Iterable[str], fmt: str = "parquet", bare: bool = False
) -> dict[str, int]:
    """As ``write_two_column`` for a run over the given ``sources``; rows written for each.

    A source of the run of which no row is left loses what an earlier run wrote.
    Rows of any other source are refused before anything is replaced.
    """
    names = list(dict.fromkeys(sources))
    known = F.col("source").isin(names) if names else F.lit(False)
    refused = F.raise_error(F.concat(F.lit("a row of a source that isn't in the run: "), F.col("source")))
    checked = df.withColumn("source", F.when(known, F.col("source")).otherwise(refused))
    seen = _write_sources(checked, path, fmt, bare, names)
    counts = {name: seen[f"rows_{i}"] for i, name in enumerate(names)}
    for name, rows in counts.items():
        if not rows:
            _drop_partition(df, path, name)
    return counts


def _write_sources(df: DataFrame, path: str, fmt: str, bare: bool, names) -> dict:
    seen = Observation()
    more = [] if bare else [c for c in ("source_ord", "row_ord", "domain") if c in df.columns]
    by_source = [F.count_if(F.col("source") == name).alias(f"rows_{i}") for i, name in enumerate(names)]
    (
        df.select("source", "cleaned_text", "sentiment_value", *more)
        .observe(seen, F.count(F.lit(1)).alias("rows"), *by_source)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source")
        .format(fmt)
        .save(path)
    )
    return seen.get


def _drop_partition(df: DataFrame, path: str, source: str) -> None:
    """Remove the folder of one source, as Spark names it."""
    context = df.sparkSession.sparkContext
    names = context._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folder = context._jvm.org.apache.hadoop.fs.Path(path, names.getPartitionPathString("source", source))
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def write_corpus(
    lines: DataFrame, path: str, by_domain: bool = False, ordered: bool = False
) -> int:
    """Write corpus lines as UTF-8 text; return how many.

    ``ordered`` sorts the whole corpus by ingest order, which costs a range
    shuffle; training does not need it. ``by_domain`` puts each domain in its
    own folder so that readers of one domain skip the rest.
    """
    seen = Observation()
    if ordered:
        lines = lines.orderBy("source_ord", "row_ord", "sent_ord")
    # Above the sort, whose sampling pass would count every row once more.
    lines = lines.observe(seen, F.count(F.lit(1)).alias("rows"))
    columns = ["value", "domain"] if by_domain else ["value"]
    writer = lines.select(*columns).write.mode("overwrite")
    if by_domain:
        writer = writer.partitionBy("domain")
    writer.text(path)
    return seen.get["rows"]
