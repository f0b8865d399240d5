"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm import bpe, periodic_runs, suffix_array
from lexispark.llm.chat import format_preferences, with_swapped_replies
from lexispark.llm.decontaminate import hits
from lexispark.llm.exact_dedup import exact_groups
from lexispark.llm.html_text import extract, learn_weights
from lexispark.llm.line_dedup import deduplicated
from lexispark.llm.ngram_join import near_duplicates
from lexispark.llm.prefix_trie import prefix_trie
from lexispark.llm.quality import score_documents
from lexispark.llm.substring_dedup import without_repeats
from lexispark.llm.warc import lookup, write_archive

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def registered(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


def vocabulary_path(name: str) -> str:
    """A vocabulary file of the public tokenizers, or one in ``TOKENIZERS_DIR``."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers  # only where a vocabulary is asked for

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A document is accepted from this score on.
ACCEPTED = 0.3


@registered
def op1_quality(spark, sf_dir):
    scores = score_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= ACCEPTED).cast("int"))


@registered
def op2_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs, counts=True).select(
        "doc_id", "n_lines", "n_exact", "n_near",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@registered
def op3_decontamination(spark, sf_dir):
    found = hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = F.size("hit_words").cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@registered
def op4_html_text(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return extract(pages, learn_weights(pages)).withColumn(
        "n_chars", F.length("text").cast("long"))


@registered
def op5_warc(spark, sf_dir):
    """Every page is written, and found again by its URL."""
    pages = _table(spark, sf_dir, "pages")
    return lookup(spark, write_archive(pages), pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@registered
def op6_exact_dedup(spark, sf_dir):
    return exact_groups(_table(spark, sf_dir, "documents"))


@registered
def op7_ngram_join(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"))


@registered
def op8_substring_dedup(spark, sf_dir):
    return without_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def byte_bpe() -> bpe.Vocabulary:
    return bpe.Vocabulary(vocabulary_path("byte_bpe_50k.json"))


@registered
def op9_bpe(spark, sf_dir):
    return digests(bpe.round_trip(_table(spark, sf_dir, "documents"), byte_bpe()))


@registered
def op10_preferences(spark, sf_dir):
    pairs = with_swapped_replies(_table(spark, sf_dir, "conversations"))
    return format_preferences(pairs)


@registered
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie(_table(spark, sf_dir, "conversations"))


@registered
def op12_suffix_array(spark, sf_dir):
    return suffix_array.without_repeats(
        _table(spark, sf_dir, "documents"), first_stays=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@registered
def op13_periodic_runs(spark, sf_dir):
    docs = periodic_runs.with_periods(_table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.collapsed(docs))


def digests(coded: DataFrame, *more: str) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
