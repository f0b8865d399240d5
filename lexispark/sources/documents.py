"""Document collections from tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.scale import spread


def read_documents(
    spark: SparkSession, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(doc_id, content)`` from Parquet; only these two columns are read."""
    docs = spark.read.parquet(path).select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("content"),
    )
    return spread(docs, "doc_id")
