import random

import pytest
from pyspark.sql import functions as F

from lexispark.functions import normalize as N
from lexispark.operators import corpus

GOLDEN = [
    ("Red fox ran", "red::fox::ran", ["red", "fox", "ran"]),
    ("sat on the hill", "sat::hill", ["sat", "hill"]),
    ("The hill", "the::hill", ["the", "hill"]),
    ("go the the end", "go::the::end", ["go", "the", "end"]),
    ("well-to-do", "well::to::do", ["well", "to", "do"]),
    ("up 3 points\nnext", "up::next", ["up", "next"]),
    ("3 up", "", [""]),
    ("-x", "::x", ["", "x"]),
    ("x -", "x::", ["x"]),
    ("-", "::", []),
    ("a_b c@d", "a_b::c@d", ["a_b", "c@d"]),
    ("U.S.", "us", ["us"]),
    ("x\ty", "x::y", ["x", "y"]),
    # Beyond the listed rows: carriage returns, other line ends, inner blanks.
    ("x\r\ny", "x::y", ["x", "y"]),
    ("x 3 y\u2028z", "x::\u2028z", ["x", "\u2028z"]),
    ("x \x0b y", "x::\x0b::y", ["x", "", "y"]),
    ("x\x0b y", "x\x0b::y", ["x", "y"]),
    ("x \x0b-", "x::\x0b::", ["x", ""]),
    ("\x0bx", "x", ["x"]),
    ("", "", [""]),
    ("go the a the end", "go::the::end", ["go", "the", "end"]),
]


def test_golden_rows(spark):
    rows = [(i, text) for i, (text, _, _) in enumerate(GOLDEN)]
    docs = spark.createDataFrame(rows, "doc_id bigint, content string")
    normalized = {r.doc_id: r.normalized for r in corpus.normalized(docs).collect()}
    tokens = {r.doc_id: r.tokens for r in corpus.tokenized(docs).collect()}
    for i, (text, want, want_tokens) in enumerate(GOLDEN):
        assert normalized[i] == want, text
        assert tokens[i] == want_tokens, text


def test_lengths_and_positions(spark):
    docs = spark.createDataFrame(
        [(1, "-x"), (2, "-"), (3, "x -"), (4, "3 up"), (5, "x \x0b y")],
        "doc_id bigint, content string",
    )
    table = corpus.token_table(docs)
    lengths = {r.doc_id: (r.doc_len, r.indexed_len) for r in table.collect()}
    assert lengths == {1: (2, 1), 2: (0, 0), 3: (1, 1), 4: (1, 0), 5: (3, 2)}
    positions = {tuple(r) for r in corpus.position_rows(table).collect()}
    assert positions == {(1, 2, "x"), (3, 1, "x"), (5, 1, "x"), (5, 3, "y")}


def test_single_steps_compose(spark):
    """The separate steps, one after the other, give the fused chain."""
    rng = random.Random(7)
    alphabet = ["a", "the", "of", "fox", "3", "7x", "-", "--", " ", "  ", "\n", "\t", "\r",
                "U.S.", "é", "È", "#", ":", "\x0b", "_", "$", "\\", "'"]
    texts = ["".join(rng.choice(alphabet) + rng.choice(["", " "]) for _ in range(30))
             for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, content string")
    for digits in N.DIGIT_MODES:
        step = N.strip_digits(N.strip_punctuation(F.col("content")), digits)
        for f in (N.lowercase, N.remove_stop_words, N.hyphens_to_spaces,
                  N.collapse_separators, N.java_trim):
            step = f(step)
        fused = N.normalize(F.col("content"), digits)
        assert frame.where(~step.eqNullSafe(fused)).count() == 0


def test_digit_modes(spark):
    frame = spark.createDataFrame([("up 3 points a1b c",)], "t string")
    assert frame.select(N.strip_digits(F.col("t"), "token")).first()[0] == "up  points a c"
    with pytest.raises(ValueError):
        N.strip_digits(F.col("t"), "none")


def test_same_term(spark):
    frame = spark.createDataFrame([(" Fox\t", "fOX"), ("fox", "foxes")], "a string, b string")
    got = [r[0] for r in frame.select(N.same_term(F.col("a"), F.col("b"))).collect()]
    assert got == [True, False]


def test_normalizer_appears_once_in_plans(docs):
    """No optimizer rule may repeat the chain below an explode."""
    table = corpus.token_table(docs)
    for frame in (corpus.term_rows(table), corpus.distinct_term_rows(table),
                  corpus.position_rows(table), corpus.biword_rows(table)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count(" with ,") == 1, plan
