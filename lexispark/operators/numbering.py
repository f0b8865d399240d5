"""Dense document numbers.

Ids may be any 64-bit numbers, hashes for example. Ranges of them then hold a document
or none, and lists, blocks or bitmaps by range fall apart. Documents are therefore
numbered from 0 in the order of their ids, in two passes: documents are written sorted
over all files and counted per file; a document's number is the count of all earlier
files plus its row in its own file. No task sees more than its own files.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.scale import materialize, shared_path

_PART = re.compile(r"part-(\d+)[^/]*$")


def write_in_order(
    docs: DataFrame, path: str, made: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Write ``docs`` to ``path``, sorted by doc_id within and over files. They are
    computed once, though sorting looks at them twice. ``made`` is computed row by row from
    sorted documents: texts are a third of the volume of their tokens, and a scan of them is
    read twice without being written first."""
    rows = docs if made else materialize(docs, "unsorted")
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    (made(rows) if made else rows).write.option("compression", "zstd").parquet(path)


def _in_file_order(path: str) -> tuple[int, str]:
    part = _PART.search(path)
    return (int(part.group(1)) if part else 0, path)


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_in_order`` has written, with ``doc_no`` from 0. Counting reads the
    footers; the driver holds one row per file."""
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    counts = {r["__file"]: r["count"] for r in rows.groupBy("__file").count().collect()}
    starts, total = [], 0
    for file in sorted(counts, key=_in_file_order):
        starts.append((file, total))
        total += counts[file]
    begins = spark.createDataFrame(starts, "__file string, __start bigint")
    return rows.join(F.broadcast(begins), "__file").withColumn(
        "doc_no", F.col("__start") + F.col("__row")).drop("__file", "__row", "__start")


def numbered(
    docs: DataFrame, made: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """``docs``, or what is ``made`` of them, with ``doc_no``, as a written table."""
    path = shared_path(docs.sparkSession, "numbered")
    write_in_order(docs, path, made)
    return read_numbered(docs.sparkSession, path)
