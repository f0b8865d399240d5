"""Helpers that keep plans sound at any size: spreading small inputs, checked
broadcasts, and tables written once to shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A frame is collected, broadcast or sent as a literal list only below these
# bounds: so many rows, each with so long a text.
SMALL_ROWS = 50_000
SMALL_TEXT = 1_000
# Longer texts among them are judged by their total length.
SMALL_TOTAL = 10_000_000
LITERAL_TERMS = 5_000


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Where none is named, a local session gets a temporary one; a cluster
    session is refused, as a machine-local folder would not survive there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="lexispark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches need the same costly rows: they then read
    columns of a written table instead of each repeating the work, and a lost
    executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    _materialized.append(path)
    return spark.read.schema(df.schema).parquet(path)


_materialized: list[str] = []


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store it is; nothing if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def remove_materialized(spark: SparkSession) -> None:
    """Delete the tables ``materialize`` has written in this process. Frames that
    read them can no longer be computed."""
    while _materialized:
        remove_folder(spark, _materialized.pop())


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Repartition a file scan that has fewer splits than the cluster has cores.

    A small file with one row group would otherwise be one task. A scan with
    enough splits, as any large one has, is left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, key)


@dataclass(frozen=True)
class Sized:
    """A frame after a size check. ``rows`` holds all of a small one's rows."""

    df: DataFrame
    rows: tuple[Row, ...] | None

    @property
    def small(self) -> bool:
        return self.rows is not None

    def hinted(self) -> DataFrame:
        """With a broadcast hint if proven small; else Spark shuffles the join
        and adaptive execution splits its skewed partitions."""
        return F.broadcast(self.df) if self.small else self.df

    def literal(self, column: str = "term") -> list[str] | None:
        """The distinct values of a small frame's column, if they are few
        enough for a literal list."""
        if self.rows is None:
            return None
        values = {row[column] for row in self.rows}
        return sorted(values) if len(values) <= LITERAL_TERMS else None


def check_size(df: DataFrame, text_column: str) -> Sized:
    """Look at no more of ``df`` than the bounds allow. A small frame becomes a
    local table, whose exact size the planner knows; a larger one stays as it
    is. A few overlong texts do not make a frame large, only their sum does."""
    cut = F.left(F.col(text_column), F.lit(SMALL_TEXT + 1)).alias(text_column)
    rows = (
        df.select(*[cut if c == text_column else c for c in df.columns])
        .limit(SMALL_ROWS + 1)
        .collect()
    )
    if len(rows) > SMALL_ROWS:
        return Sized(df, None)
    if any(len(row[text_column]) > SMALL_TEXT for row in rows):
        long = F.char_length(text_column) > SMALL_TEXT
        total = df.where(long).agg(F.sum(F.char_length(text_column))).first()[0]
        if total > SMALL_TOTAL:
            return Sized(df, None)
        rows = df.collect()
    return Sized(local_table(df.sparkSession, rows, df.schema), tuple(rows))


_ARROW_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def local_table(spark: SparkSession, rows: Sequence, schema: T.StructType) -> DataFrame:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    table = pa.Table.from_arrays(
        [pa.array(column, _ARROW_TYPES[field.dataType.simpleString()])
         for column, field in zip(columns, schema, strict=True)],
        names=schema.names,
    )
    return spark.createDataFrame(table, schema)


def in_list(column: str, values: Sequence[str]) -> str:
    """SQL for ``column IN (values)``. As text it is parsed at once; built value
    by value, a list of thousands takes seconds."""
    if not values:
        return "false"
    quoted = ("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return f"{column} IN ({', '.join(quoted)})"


# A set of bits is at most so many numbers of 64 bits each, so it may be part of a plan.
MOST_BIT_NUMBERS = 1 << 15
BITS_PER_VALUE = 16


@dataclass(frozen=True)
class BitSet:
    """Which hashes occur among some values: a filter for use inside a row. What it keeps may
    not be among them (one in sixteen, more if there are over 130,000), what it drops is not."""

    masks: str  # SQL of an array of 64-bit numbers
    bits: int

    @staticmethod
    def of(values: DataFrame, column: str) -> BitSet:
        """Built by tasks; the driver gets at most ``MOST_BIT_NUMBERS`` numbers."""
        distinct = values.select(column).distinct()
        wanted = max(distinct.count() * BITS_PER_VALUE // 64, 16)
        numbers = min(1 << (wanted - 1).bit_length(), MOST_BIT_NUMBERS)
        bit = F.pmod(F.xxhash64(column), F.lit(numbers * 64))
        packed = distinct.select(bit.alias("bit")).groupBy(
            F.expr("cast(bit div 64 as int)").alias("slot")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("mask"))
        masks = ["0"] * numbers
        for slot, mask in packed.collect():
            masks[slot] = str(mask)
        return BitSet(f"cast(split('{','.join(masks)}', ',') as array<bigint>)", numbers * 64)

    def may_hold(self, value: str) -> str:
        """SQL for whether ``value``, an expression, may be among the values."""
        bit = f"pmod(xxhash64({value}), {self.bits}L)"
        return (f"(shiftright(element_at({self.masks}, cast({bit} div 64 as int) + 1),"
                f" cast({bit} % 64 as int)) & 1L) = 1L")


def segment_of(doc_id: Column, bits: int) -> Column:
    """The id range of ``2**bits`` ids that ``doc_id`` falls into. Grouping by
    (term, segment) bounds each posting list, however common the term."""
    return F.shiftright(doc_id, bits)
