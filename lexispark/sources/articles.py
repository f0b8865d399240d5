"""XML articles to documents.

Fields are taken in one parse per article by an Arrow-batched function: Spark's
own XPath functions parse once per field and end the job at the first
malformed text, where here it becomes a row with ``_error``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispark.functions.normalize import java_trim
from lexispark.operators.runs import slices

FIELDS = ("title", "headline", "text")
COLUMNS = ("item", "date", *FIELDS, "error")
ARTICLE_TYPE = T.StructType([T.StructField(name, T.StringType()) for name in COLUMNS])
SLICE_BYTES = 1 << 20


# Charsets the XML parser decodes itself; others are decoded before.
PARSED_CHARSETS = ("utf-8", "utf-16", "us-ascii", "iso-8859-1")
DECLARED = re.compile(rb"""^\s*<\?xml[^>]*?\sencoding\s*=\s*["']([A-Za-z][\w.\-]*)["']""")


def as_parsed(content: bytes) -> tuple[bytes, str | None]:
    """The content, and the charset to parse it in if that is not the declared one."""
    declared = DECLARED.match(content[:300])
    charset = declared[1].decode().lower() if declared else "utf-8"
    if charset in PARSED_CHARSETS:
        return content, None
    return content.decode(charset).encode("utf-8"), "utf-8"


def parse_article(content: bytes | None) -> tuple:
    """Root attributes ``itemid`` and ``date``, and the text inside the first
    ``title``, ``headline`` and ``text`` element below the root. The encoding
    is the declared one; external entities are not resolved."""
    root: dict[str, str] = {}
    found: dict[str, list[str]] = {}
    open_fields: list[tuple[str, int]] = []
    depth = 0

    def start(tag, attributes):
        nonlocal depth
        if depth == 0:
            root.update(attributes)
        elif tag in FIELDS and tag not in found:
            found[tag] = []
            open_fields.append((tag, depth))
        depth += 1

    def end(_):
        nonlocal depth
        depth -= 1
        if open_fields and open_fields[-1][1] == depth:
            open_fields.pop()

    def text(data):
        for field, _ in open_fields:
            found[field].append(data)

    try:
        content, charset = as_parsed(content or b"")
    except (UnicodeDecodeError, LookupError) as error:
        return (None, None, None, None, None, f"malformed XML: {error}")
    parser = expat.ParserCreate(charset)
    parser.StartElementHandler = start
    parser.EndElementHandler = end
    parser.CharacterDataHandler = text
    try:
        parser.Parse(content, True)
    except (expat.ExpatError, ValueError, LookupError) as error:
        return (None, None, None, None, None, f"malformed XML: {error}")
    fields = ("".join(found.get(field, ())) for field in FIELDS)
    return (root.get("itemid"), root.get("date"), *fields, None)


def _parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Articles are parsed and passed on by the megabyte: a batch has a number of rows, not
    of bytes, and its parsed texts would all be held beside it."""
    for contents in batches:
        sizes = pc.fill_null(pc.binary_length(contents), 0).to_numpy()
        for some in slices(contents, sizes, SLICE_BYTES):
            parsed = [parse_article(content.as_py()) for content in some]
            columns = zip(*parsed, strict=True) if parsed else [()] * len(COLUMNS)
            yield pa.StructArray.from_arrays(
                [pa.array(column, pa.string()) for column in columns], list(COLUMNS))


def extract_articles(entries: DataFrame) -> DataFrame:
    """Archive entries to ``(doc_id, content, doc_date, raw_date, archive, name,
    _error)``.

    ``content`` is the three fields, each trimmed, joined by one space; a field
    the article lacks is empty. ``_error`` is set, and ``doc_id`` null, where
    the entry could not be read or parsed or its id is not a whole number.
    """
    article = F.col("article")
    trimmed = [java_trim(article[field]) for field in FIELDS]
    doc_id = F.expr("try_cast(trim(article.item) AS BIGINT)")
    error = F.coalesce(
        "_error",
        article["error"],
        F.when(
            doc_id.isNull(),
            F.concat(F.lit("item id is not a whole number: "), F.coalesce(article["item"], F.lit(""))),
        ),
    )
    # Declared nondeterministic so that a filter on the result is not pushed
    # below it, which would parse every article twice.
    parse = F.arrow_udf(_parsed, ARTICLE_TYPE).asNondeterministic()
    return (
        entries.withColumn("article", parse(F.col("content")))
        .select(
            doc_id.alias("doc_id"),
            F.concat_ws(" ", *trimmed).alias("content"),
            F.expr("CAST(try_to_timestamp(article.date, 'yyyy-MM-dd') AS DATE)").alias("doc_date"),
            article["date"].alias("raw_date"),
            "archive",
            "name",
            error.alias("_error"),
        )
    )


def documents(articles: DataFrame) -> DataFrame:
    """The sound articles as documents."""
    return articles.where(F.col("_error").isNull()).select(
        "doc_id", "content", "doc_date", "raw_date"
    )


def quarantined(articles: DataFrame) -> DataFrame:
    """The rest, with the reason."""
    return articles.where(F.col("_error").isNotNull()).select("archive", "name", "_error")
