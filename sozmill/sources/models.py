"""Embedding models as tables of ``word, vector, cnt``."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Buckets of a stored model; a join on the word then needs no shuffle of its rows.
BUCKETS = 64
_INFO = "_model"


def save_vectors(vectors: DataFrame, path: str) -> None:
    vectors.select("word", "vector", "cnt").write.mode("overwrite").parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored vectors, or None if there is no model at ``path``."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise


def _table_name() -> str:
    return f"sozmill_model_{uuid.uuid4().hex}"


def save_bucketed(vectors: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store a model in ``buckets`` files, by the hash of the word and sorted by it.

    The number of buckets is stored beside it. Choose it by the model's size: a
    bucket is read by one task.
    """
    spark, name = vectors.sparkSession, _table_name()
    rows = vectors.select("word", "vector", "cnt").repartition(buckets, "word")
    rows.write.mode("overwrite").format("parquet").option("path", f"{path}/vectors").bucketBy(
        buckets, "word").sortBy("word").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").json(f"{path}/{_INFO}")


def load_bucketed(spark: SparkSession, path: str) -> DataFrame | None:
    """A model stored by ``save_bucketed``, None if there is none.

    Lookups of pairs and coverage join it by word where its rows lie: only the
    other side is shuffled, if it is large.
    """
    try:
        buckets = spark.read.schema("buckets int").json(f"{path}/{_INFO}").first().buckets
        schema = spark.read.parquet(f"{path}/vectors").schema
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise
    name = _table_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    where = f"{path}/vectors".replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (word) SORTED BY (word) "
              f"INTO {buckets} BUCKETS LOCATION '{where}'")
    return spark.table(name)
