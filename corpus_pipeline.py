"""From raw documents to token ids, in five stages.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet
and read again as the next one's ``docs``, so that no stage depends on the lineage
of another and a lost executor costs a re-read. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm import bpe, decontaminate, line_dedup, ngram_join, quality
from lexispark.llm.queries import ACCEPTED, byte_bpe, digests
from lexispark.scale import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts. It learns from the labels, except
    those of the held-out fold."""
    return quality.accept(docs, _table(spark, sf_dir, "labels"), ACCEPTED)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that are, within two edits, in an earlier place; n_chars
    follows. A document of which nothing is left goes; one that was blank stays."""
    cut = line_dedup.deduplicated(docs, counts=True)
    changed = (F.col("n_exact") + F.col("n_near")) > 0
    left = cut.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn(
        "n_chars",
        F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType))
        .otherwise(F.col("n_chars"))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each class linked by shingles."""
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.drop_documents(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, with their number and digests, and the digest
    of the text decoded from them."""
    return digests(bpe.round_trip(docs, byte_bpe()), "ids")


STAGES = [
    ("quality classifier", accept_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding", encode),
]

# SQL expresses neither the classifier nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
