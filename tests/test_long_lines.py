"""Text indexes with lines longer than a split."""

import random

import pytest
from pyspark.sql import functions as F

from lexispark.scale import shared_path
from lexispark.sources import index_text, long_lines


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def lines(tab):
    rng = random.Random(3)
    out = []
    for term, n in (("a", 1), ("common", 30_000), ("b", 2), ("kürze", 9000), ("c", 1), ("d", 400)):
        docs = sorted(rng.sample(range(10**12), n))
        out.append(f"{term}:{n};" + "".join(
            f"{d}:{','.join(str(p) for p in range(1, 2 + d % 4))};" for d in docs) + tab)
    return out


@pytest.mark.parametrize("tab", ["\t", ""])
def test_positional(spark, small_splits, tab):
    path = shared_path(spark, "test-long")
    rows = spark.createDataFrame([(x,) for x in lines(tab)], "value string").coalesce(1)
    index_text.write_lines(rows, path)
    records = long_lines._records(spark, path, ";")
    assert records.rdd.getNumPartitions() > 20  # the longest line alone has half of the bytes
    got = long_lines.read_positional(spark, path)
    want = index_text.read_positional(spark, path)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_id_rows(spark, small_splits):
    rng = random.Random(5)
    path = shared_path(spark, "test-long")
    rows = [(t, " ".join(map(str, sorted(rng.sample(range(10**12), n))))) for t, n in (
        ("a", 1), ("common", 40_000), ("b", 1), ("c", 3), ("kürze", 5000), ("d", 1))]
    frame = spark.createDataFrame(rows, "term string, ids string").coalesce(2)
    index_text.write_lines(frame.select(F.concat_ws("\t", "term", "ids").alias("value")), path)
    assert long_lines._records(spark, path, " ").rdd.getNumPartitions() > 20
    got = long_lines.read_id_rows(spark, path)
    want = index_text.read_id_lists(spark, path).select("term", F.explode("doc_ids"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_nothing(spark):
    path = shared_path(spark, "test-long")
    index_text.write_lines(spark.createDataFrame([], "value string"), path)
    assert long_lines.read_positional(spark, path).count() == 0
    assert long_lines.read_id_rows(spark, path).count() == 0
