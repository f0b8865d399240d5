"""Query texts to terms, by the same normalizer as documents.

Queries are a table ``(query_id, text)``, so one job answers many of them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispark.functions import normalize as N
from lexispark.operators import corpus
from lexispark.scale import local_table

QUERY_TYPE = T.StructType(
    [T.StructField("query_id", T.LongType()), T.StructField("text", T.StringType())]
)


def query_table(spark: SparkSession, queries: Mapping[int, str] | str) -> DataFrame:
    """``(query_id BIGINT, text STRING)`` of one text or of texts by id."""
    if isinstance(queries, str):
        queries = {1: queries}
    rows = [(int(key), text) for key, text in queries.items()]
    return local_table(spark, rows, QUERY_TYPE)


def query_words(queries: DataFrame, digits: str = "line") -> DataFrame:
    """``(query_id, pos, term)``: one row per non-blank word, repeats included."""
    return (
        corpus.tokenized(queries.select("query_id", "text"), digits, text="text")
        .select("query_id", F.posexplode_outer("tokens").alias("pos", "term"))
        .where(F.col("term") != "")
        .select("query_id", (F.col("pos") + 1).alias("pos"), "term")
    )


def query_bag(queries: DataFrame, digits: str = "line") -> DataFrame:
    """``(query_id, term, qtf)``."""
    return (
        query_words(queries, digits)
        .groupBy("query_id", "term")
        .agg(F.count("*").alias("qtf"))
    )


def split_operands(queries: DataFrame) -> DataFrame:
    """``(query_id, clause, operand)`` of boolean query texts.

    ``OR`` between white space separates clauses, ``AND`` the operands of one, so AND
    binds tighter. Operators are found before normalizing, which would lowercase
    and drop them, and would let a digit in one operand delete the next.
    """
    clauses = queries.select(
        "query_id", F.posexplode(F.split("text", r"\s+OR\s+")).alias("clause", "text")
    )
    return clauses.select(
        "query_id", "clause", F.explode(F.split("text", r"\s+AND\s+")).alias("operand")
    )


def clause_terms(queries: DataFrame, phrases: bool = False, digits: str = "line") -> DataFrame:
    """``(query_id, clause, term, n_terms)``: the distinct terms a document
    needs to meet each clause. With ``phrases`` each operand is one term, its words
    joined by spaces: of two words it is a key of the biword index."""
    tokens = corpus.tokenized(split_operands(queries), digits, text="operand")
    words = F.array_remove("tokens", "")
    keys = F.array(F.array_join(words, " ")) if phrases else words
    return (
        tokens.select("query_id", "clause", F.explode(keys).alias("term"))
        .where(F.col("term") != "")
        .groupBy("query_id", "clause")
        .agg(F.collect_set("term").alias("terms"))
        .select(
            "query_id",
            "clause",
            F.size("terms").cast("bigint").alias("n_terms"),
            F.explode("terms").alias("term"),
        )
    )
