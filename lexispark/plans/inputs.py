"""Inputs of the registered queries, all derived from the ``documents`` and
``benchmark`` tables."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.operators import corpus
from lexispark.operators.query_text import query_table
from lexispark.scale import shared_path
from lexispark.sources.archives import as_uri
from lexispark.sources.documents import read_documents

RANK_QUERIES = {1: "this tion", 2: "Leon this this zzzabsent", 3: "eriner tion-leon the end"}
ONE_QUERY = "this tion leon"
BOOLEAN_QUERIES = {
    1: "this AND tion",
    2: "leon OR tion",
    3: "this AND zzzabsent",
    4: "This tion leon",
    5: "leon AND this OR tion",
    6: "Leon! OR zzzabsent",
    7: "zzzabsent OR this 7 AND tion",
    8: "zzzabsent OR this\nAND tion OR leon AND zzzabsent",
    9: "7 AND zzzabsent",
}
PHRASE_QUERIES = {
    1: "eriner thanea",
    2: "eriner thanea OR onlyhe this",
    3: "eriner thanea AND ingre onanshat",
    4: "thanea zzzabsent",
    5: "eriner thanea AND anea eriner OR onlyhe this",
    6: "zzzabsent thanea OR thanea eriner 7 AND eriner thanea",
    7: "anea eriner thanea",
}
# All pairs of the last ones stand in documents that have the words elsewhere.
LONG_PHRASE_QUERIES = {
    1: "the attion thanedble",
    2: "thanedble anea eriner thanea OR eaesth thesedst thedones",
    3: "anea eriner thanea AND this",
    4: "eriner thanea eriner thanea",
    5: "anea eriner anea eriner thanea OR zzzabsent thanea anea",
    6: "ti thintith 7 th ththhaea OR the attion",
}
ARCHIVE_DOCS = 100
# Ids spread over most of the 63 bits, in another order; the same text in Spark and ANSI SQL.
SPARSE_ID = "(doc_id * 7368787 + 12345) % 1000003 * 9000000000037 + doc_id"

# The article each document is archived as; the same text in Spark and ANSI SQL.
ARTICLE_DATE = "date_add(date'2000-01-01', CAST(doc_id % 1000 AS INT))"
ARTICLE_XML = """
    '<newsitem itemid="' || doc_id || '" date="' || {date} || '"><title> ' || source ||
    '</title><headline>' || lang || ' </headline><text><p>' ||
    replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') ||
    '</p></text></newsitem>'
"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, f"{sf_dir}/documents.parquet")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.token_table(documents(spark, sf_dir))


def rank_queries(spark: SparkSession) -> DataFrame:
    return query_table(spark, RANK_QUERIES)


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark text as a query."""
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        F.col("item_id").alias("query_id"), "text"
    )


def _archive_writer(folder: str, truncated: bool):
    """Writes the articles of one group as one zip file. ``truncated`` cuts the
    file inside its last entry, which also loses the directory."""

    def write(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            for doc_id, xml in zip(group["doc_id"], group["xml"], strict=True):
                archive.writestr(f"{doc_id}.xml", xml.encode("utf-8"))
            last = archive.infolist()[-1]
        content = buffer.getvalue()
        if truncated:
            content = content[: last.header_offset + 30 + len(last.filename) + last.compress_size // 2]
        number = int(group["archive"].iloc[0])
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        # Written aside and moved, so that a repeated task leaves no half file.
        aside = f"{root}/.{number}-{hash(content) & 0xFFFFFFFF}.tmp"
        with system.open_output_stream(aside) as out:
            out.write(content)
        system.move(aside, f"{root}/{number}.zip")
        return pd.DataFrame({"archive": [number], "articles": [len(group)]})

    return write


def article_archives(spark: SparkSession, sf_dir: str, truncated: bool = False) -> str:
    """Archive all documents as zipped articles, a bounded number per archive,
    in the shared folder; returns where."""
    folder = as_uri(shared_path(spark, "archives"))
    articles = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        F.expr(f"doc_id div {ARCHIVE_DOCS}").alias("archive"),
        F.expr(ARTICLE_XML.format(date=ARTICLE_DATE)).alias("xml"),
    )
    written = articles.groupBy("archive").applyInPandas(
        _archive_writer(folder, truncated), "archive bigint, articles bigint"
    )
    written.agg(F.sum("articles")).collect()
    return folder
