"""Benchmark decontamination: find benchmark passages in documents and remove them.

A window is a run of N words of a benchmark item; an item with fewer words is one
window. Windows of a document are matched in three steps, all of them built-in
expressions: hashes of all its word runs probe a broadcast hash set of the windows, the
runs that are in it carry their words on, and a join with the windows decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import BROADCAST_NUMBERS, small_side
from lexispark.scale import materialize

WINDOW = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of lower-cased text
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same places, before that
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Hashes of one broadcast set. More windows are scanned for in several passes.
SET_ROWS = 1_000_000
PIECE_WORDS = 8192  # words of a document in one row of the scan


def words(text: str) -> Column:
    """Words of the text with A-Z in lower case; a null text has none."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _paired(left: str, right: str, shift: int) -> Column:
    """hash(left[i], right[i + shift]); past the end of a text it is of no use."""
    moved = F.slice(right, shift + 1, F.size(right) + 1)
    return F.zip_with(left, moved, lambda a, b: F.xxhash64(a, b))


def with_run_hashes(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Add for each length an array ``run<length>`` with a hash for each run of so
    many of the words ``w``. Runs of 1, 2, 4, 8 words are doubled up, and those that
    add up to a length are joined. Each step is a column of its own, since an
    expression repeated within another would be computed again each time."""
    longest = max(lengths, default=1)
    rows = rows.withColumn("d1", F.transform("w", lambda w: F.xxhash64(w)))
    width = 1
    while width * 2 <= longest:
        rows = rows.withColumn(f"d{width * 2}", _paired(f"d{width}", f"d{width}", width))
        width *= 2
    for length in lengths:
        parts = [1 << i for i in range(length.bit_length()) if length >> i & 1]
        name, covered = f"d{parts[-1]}", parts[-1]
        for part in reversed(parts[:-1]):
            rows = rows.withColumn(f"p{length}_{part}", _paired(name, f"d{part}", covered))
            name, covered = f"p{length}_{part}", covered + part
        rows = rows.withColumn(f"run{length}", F.col(name))
    return rows


def windows_of(benchmark: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """Distinct (item_id, size, words): the windows of each item."""
    items = benchmark.select(F.col(item_id).alias("item_id"), words(text).alias("w"))
    items = items.where("size(w) > 0").withColumn("size", F.least(F.size("w"), F.lit(window)))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("at")
    rows = items.select("item_id", "w", "size", at)
    return rows.select(
        "item_id", "size", F.expr("array_join(slice(w, at, size), ' ')").alias("words")
    ).distinct()


def _window_hashes(windows: DataFrame, sizes: list[int]) -> DataFrame:
    """A written table of the distinct hashes of all windows."""
    rows = windows.select("size", F.split("words", " ").alias("w"))
    rows = with_run_hashes(rows, sizes)
    whole = F.lit(None).cast("bigint")
    for size in sizes:
        whole = F.when(F.col("size") == size, F.element_at(f"run{size}", 1)).otherwise(whole)
    return materialize(rows.select(whole.alias("hash")).distinct(), "benchmark-hashes")


def _pieces(rows: DataFrame, longest: int) -> DataFrame:
    """Rows of at most ``PIECE_WORDS`` words each and those a run may reach beyond, from
    ``start``; a document without words has one. So no row has hashes of a whole long text."""
    cut = F.expr(
        f"transform(sequence(0, greatest(size(w) - 1, 0) div {PIECE_WORDS}),"
        f" k -> slice(w, cast(k * {PIECE_WORDS} + 1 as int), {PIECE_WORDS + longest - 1}))")
    rows = rows.select("row", "doc_id", "version", F.size("w").cast("long").alias("n_words"),
                       F.posexplode(cut).alias("piece", "w"))
    return rows.withColumn("start", F.col("piece") * PIECE_WORDS)


def scan(docs: DataFrame, windows: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A written table (row, doc_id, version, n_words, at, size, words): per document one
    row with a null ``at``, and one for each run whose hash is that of a window. Rows are
    numbered, so that repeated and null ids stay apart."""
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())
    hashes = _window_hashes(windows, sizes)
    passes = max(-(-hashes.count() // SET_ROWS), 1)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
        _version(text).alias("version"), F.col(text).alias("text"))
    if passes > 1:  # all passes see the same numbers
        rows = materialize(rows, "benchmark-rows")
    pieces = _pieces(
        rows.withColumn("w", words("text")), max(sizes, default=1))
    hashed = with_run_hashes(pieces, sizes)
    # One array of all hashes: an entry that stands for the document, then for each
    # size as many as there are words.
    entries = F.concat(F.expr("array(cast(null as bigint))"), *[f"run{size}" for size in sizes])
    entries = hashed.select("row", "doc_id", "version", "n_words", "piece", "start", "w",
                            F.posexplode(entries).alias("entry", "hash"))
    place = F.expr("(entry - 1) % greatest(size(w), 1)")
    listed = ", ".join(map(str, sizes or [0]))
    size = F.expr(f"element_at(array({listed}), cast(least(greatest(entry - 1, 0) div"
                  f" greatest(size(w), 1), {max(len(sizes), 1) - 1}) as int) + 1)")
    found = None
    for number in range(passes):
        part = hashes.where(F.pmod(F.xxhash64("hash"), F.lit(passes)) == number)
        part = F.broadcast(part.withColumn("known", F.lit(True)))
        # Runs past the end of the text are none; those past the piece are the next one's.
        real = (F.col("known") & (place + size <= F.size("w")) & (place < PIECE_WORDS))
        head = (F.col("entry") == 0) & (F.col("piece") == 0) & F.lit(number == 0)
        some = entries.join(part, "hash", "left").where(head | real).select(
            "row", "doc_id", "version", "n_words",
            F.when(F.col("entry") > 0, F.col("start") + place).cast("int").alias("at"),
            size.alias("size"),
            F.when(F.col("entry") > 0, F.array_join(
                F.slice("w", place.cast("int") + 1, size), " ")).alias("words"))
        some = materialize(some, "benchmark-scan")
        found = some if found is None else found.unionAll(some)
    return found


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id",
         text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, version (a hash of the text), n_words,
    hit_words (indexes, from 0, of the words inside any occurrence of a window),
    item_ids (as sorted strings).

    Null texts have no words; a document without words or a benchmark without rows
    gives no hit. Items that share a window or an id are told once; a null item id
    hits but has no id to tell. Other columns are ignored.

    Hashes of windows are broadcast, ``SET_ROWS`` at a time; the windows themselves if they
    are few, else they are joined by a shuffle, whose skewed partitions adaptive execution
    splits. Very long texts are scanned in pieces. What is kept per document is bounded
    by its own words.
    """
    windows = materialize(
        windows_of(benchmark, window, item_id, item_text), "benchmark-windows")
    scanned = scan(docs, windows, doc_id, text)
    runs = scanned.where("at is not null").select("row", "at", "size", "words")
    keys = ["size", "words"]
    matched = materialize(
        runs.join(small_side(windows.select(*keys).distinct()), keys, "left_semi"),
        "benchmark-hits")
    covered = matched.groupBy("row").agg(F.expr(
        "array_sort(array_distinct(flatten(collect_list(sequence(at, at + size - 1)))))"
    ).alias("hit_words"))
    items = matched.select("row", *keys).distinct().join(small_side(windows), keys)
    items = items.select("row", F.col("item_id").cast("string").alias("item")).distinct()
    items = items.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    found = covered.join(items, "row")
    documents = scanned.where("at is null")
    return documents.select("row", "doc_id", "version", "n_words").join(found, "row", "left").select(
        "doc_id", "version", "n_words",
        F.coalesce("hit_words", F.expr("cast(array() as array<int>)")).alias("hit_words"),
        F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"))


def drop_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark window, unchanged. Rows that share an
    id, null included, are told apart by their texts."""
    hit = hits(docs, benchmark, window, doc_id, text).where("size(hit_words) > 0")
    hit = materialize(hit.select(
        F.col("doc_id").alias("__hit"), F.col("version").alias("__version")).distinct(),
        "benchmark-ids")
    return docs.join(small_side(hit), _same(docs, hit, doc_id, text), "left_anti")


def _version(text: str) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _same(docs: DataFrame, hit: DataFrame, doc_id: str, text: str) -> Column:
    return docs[doc_id].eqNullSafe(hit["__hit"]) & (_version(text) == hit["__version"])


def cut_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
              doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the words inside benchmark windows cut from the text, each with
    what separates it from the next word. The places to cut are broadcast if they are few."""
    hit = hits(docs, benchmark, window, doc_id, text).where("size(hit_words) > 0")
    hit = materialize(
        hit.groupBy(F.col("doc_id").alias("__hit"), F.col("version").alias("__version")).agg(
            F.first("hit_words").alias("__cut")), "benchmark-cuts")
    numbers = hit.agg(F.sum(F.size("__cut"))).first()[0] or 0
    cuts = F.broadcast(hit) if numbers <= BROADCAST_NUMBERS else hit
    joined = docs.join(cuts, _same(docs, hit, doc_id, text), "left")
    joined = joined.withColumn(
        "__words", F.regexp_extract_all(text, F.lit(CASED_WORD), F.lit(0)))
    joined = joined.withColumn("__between", F.split(text, CASED_WORD, -1))
    kept = F.expr(
        "concat(__between[0], array_join(transform("
        "array_except(sequence(0, size(__words) - 1), __cut),"
        " i -> concat(__words[i], __between[i + 1])), ''))")
    cut = F.when(F.col("__cut").isNull(), F.col(text)).otherwise(kept)
    return joined.withColumn(text, cut).select(*docs.columns)
