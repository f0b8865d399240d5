"""Batch full-text search over document collections on Spark."""

from lexispark.operators.boolean import boolean_search, phrase_search
from lexispark.operators.corpus import token_table
from lexispark.operators.query_text import query_table
from lexispark.operators.ranking import (
    QueryTerms,
    bm25,
    bm25_factored,
    scan_documents,
    searchable,
    tf_idf,
    top_k,
)
from lexispark.sources.archives import read_archives
from lexispark.sources.articles import extract_articles
from lexispark.sources.documents import read_documents
from lexispark.sources.index_store import build_index, read_index

__all__ = [
    "QueryTerms",
    "bm25",
    "bm25_factored",
    "boolean_search",
    "build_index",
    "extract_articles",
    "phrase_search",
    "query_table",
    "read_archives",
    "read_documents",
    "read_index",
    "scan_documents",
    "searchable",
    "tf_idf",
    "token_table",
    "top_k",
]
