"""Classifier, decontamination, extraction, tokenizing and chat formatting."""

import html
import json
import os
import random
import re
import time

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexispark.llm import bpe, chat, decontaminate, html_text, quality
from lexispark.llm.queries import ACCEPTED, vocabulary_path
from lexispark.llm.text import flat

SF_DIR = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")
vocabularies = pytest.mark.skipif(
    not os.path.isfile(vocabulary_path("byte_bpe_50k.json")), reason="no vocabularies")
DOCS = "doc_id bigint, text string"


# --- quality


def test_statistics_of_odd_texts():
    texts = ["", None, "\n", " \t ", "a", "A.\n\nb", "x" * 100_000, "é €", "a\na\na"]
    rows = quality.statistics(*flat(pa.array(texts)))
    assert rows.shape == (len(texts), len(quality.STATISTICS)) and np.isfinite(rows).all()
    alone = np.concatenate([quality.statistics(*flat(pa.array([t], pa.string()))) for t in texts])
    assert np.allclose(rows, alone)
    named = dict(zip(quality.STATISTICS, rows[8], strict=True))
    assert named["lines"] == pytest.approx(np.log(4))
    assert named["distinct_lines"] == pytest.approx(np.sqrt(1 / 3))
    assert named["repeated_words"] == pytest.approx(np.sqrt(2 / 3))


def test_discriminant_equals_gaussian_densities():
    rng = np.random.default_rng(0)
    x = [rng.normal(size=(400, 3)) @ rng.normal(size=(3, 3)) + m for m in (0, 2)]
    model = quality.discriminant(
        [400, 400], np.array([v.sum(0) for v in x]), np.array([v.T @ v for v in x]), 0.0, 0.0)
    at = rng.normal(size=(5, 3))
    every = np.concatenate(x)
    shares = 3 / 403  # the pooled share of a class with so few rows
    pooled = sum(np.cov(v.T, bias=True) for v in x) / 2
    want = []
    for v in x:
        cov = (1 - shares) * np.cov(v.T, bias=True) + shares * pooled
        d = at - v.mean(0)
        want.append(-0.5 * (d @ np.linalg.inv(cov) * d).sum(1) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.log_odds(at), want[1] - want[0])
    assert every.shape == (800, 3)


def test_quality_scores(spark):
    rng = random.Random(3)
    good = [" ".join(rng.choice(["the", "cat", "runs", "far", "away"]) + rng.choice(["", ",", "."])
                     for _ in range(60)) for _ in range(150)]
    bad = [" ".join(rng.choice(["BUY!!", "NOW$$", "%%%"]) for _ in range(40)) for _ in range(150)]
    rows = list(enumerate(good + bad)) + [(1000, None), (1001, ""), (None, "x"), (7, good[7])]
    docs = spark.createDataFrame(rows, DOCS).withColumns(
        {c: F.lit(1) for c in ("key", "score", "statistics", "quality")})
    labels = spark.createDataFrame(
        [(i, int(i < 150)) for i in range(300)] + [(None, 1), (3, None), (5, 9)],
        "doc_id bigint, quality int")
    got = quality.score_documents(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert len(held) > 30
    assert np.mean([(r.score >= ACCEPTED) == (r.doc_id < 150) for r in held]) > 0.95
    assert [r.held_out for r in got if r.doc_id is None] == [None]
    kept = quality.accept(docs, labels, ACCEPTED)
    assert kept.columns == docs.columns
    assert kept.where("doc_id < 150").count() >= 145
    none = quality.score_documents(docs.limit(5), labels.limit(0)).collect()
    assert [r.score for r in none] == [0.5] * 5
    assert quality.score_documents(docs.limit(0), labels).count() == 0


def test_held_out_labels_are_not_used(spark):
    docs = spark.createDataFrame([(i, "a b. " * (i % 7)) for i in range(60)], DOCS)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    held = quality.held_out(F.col("doc_id"))
    flipped = labels.withColumn(
        "quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted(map(tuple, quality.score_documents(docs, x).collect()))
                for x in (labels, flipped))
    assert one == two


# --- decontamination


def test_hits_and_removal(spark):
    items = [(1, "One two three"), (2, "a b c d e f g h i j k"), (3, ""), (4, None),
             (1, "one TWO three"), (10, "five"), (None, "six six"), (11, "five")]
    rows = [(1, "x One, two;three y one Two"), (2, "A b c d e f g h i j K l"), (3, None), (4, ""),
            (5, "five-six six six FIVE"), (6, "é five"), (7, "clean " * 3000), (8, "a b c d e"),
            (9, "one two three " * 40)]
    docs = spark.createDataFrame(rows, DOCS).withColumns(
        {c: F.lit(1) for c in ("words", "size", "w", "row", "item_id", "found", "at")})
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.hit_words, r.item_ids)
           for r in decontaminate.hits(docs, benchmark).collect()}
    assert got == brute.hits(rows, items)
    kept = decontaminate.drop_documents(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {3, 4, 7, 8}
    cut = {r.doc_id: r.text for r in decontaminate.cut_spans(docs, benchmark).collect()}
    assert (cut[1], cut[2], cut[3], cut[5], cut[6]) == ("x y one Two", "l", None, "", "é ")
    assert cut[7] == rows[6][1] and cut[9] == ""


def test_hits_at_every_window_size(spark):
    rng = random.Random(6)
    draw = lambda n: " ".join(rng.choice("pqr") for _ in range(n))
    items = [(i, draw(n)) for i, n in enumerate([*range(1, 13), 20])]
    rows = [(i, draw(rng.randrange(40))) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: (r.n_words, r.hit_words, r.item_ids) for r in decontaminate.hits(
        docs, spark.createDataFrame(items[6:], "item_id bigint, text string")).collect()}
    assert got == brute.hits(rows, items[6:])


def test_long_texts_and_many_windows_change_no_hit(spark, monkeypatch):
    """Texts in many pieces, windows in many passes."""
    rng = random.Random(8)
    draw = lambda n: " ".join(rng.choice("pqrs") for _ in range(n))
    items = [(i, draw(rng.choice((2, 5, 10, 14)))) for i in range(12)]
    rows = [(i, draw(rng.randrange(60))) for i in range(40)]
    rows += [(None, rows[3][1]), (50, None), (51, ""), (52, items[3][1])]
    docs = spark.createDataFrame(rows, DOCS)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for piece, entries in ((7, 10**6), (1, 10**6), (8192, 5), (11, 3)):
        monkeypatch.setattr(decontaminate, "PIECE_WORDS", piece)
        monkeypatch.setattr(decontaminate, "SET_ROWS", entries)
        got = {r.doc_id: (r.n_words, r.hit_words, r.item_ids)
               for r in decontaminate.hits(docs, benchmark).collect()}
        assert got == brute.hits(rows, items)


def test_only_windows_pass_the_scan(spark):
    """However many windows there are, no other runs are carried on."""
    words = spark.range(30_000).select(F.col("id").alias("item_id"), F.concat_ws(
        " ", *[F.sha1(F.concat_ws(",", "id", F.lit(i))) for i in range(20)]).alias("text"))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[
        F.sha1(F.concat_ws(",", F.col("id") + 10**6, F.lit(i))) for i in range(80)])
        .alias("text")).union(words.limit(5).select("item_id", "text"))
    windows = decontaminate.windows_of(words, 10, "item_id", "text")
    scanned = decontaminate.scan(docs, windows, "doc_id", "text")
    assert scanned.where("at is null").count() == 305
    assert scanned.where("at is not null").count() == 5 * 11


def test_no_hits(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], DOCS)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [r.hit_words for r in decontaminate.hits(docs, none).collect()] == [[]] * 3
    assert decontaminate.hits(docs.limit(0), none).count() == 0
    one = spark.createDataFrame([(1, "b")], "item_id bigint, text string")
    assert decontaminate.drop_documents(docs, one).count() == 0
    mixed = docs.union(spark.createDataFrame([(None, "clean"), (1, "clean")], DOCS))
    kept = decontaminate.drop_documents(mixed, one).collect()
    assert [r.text for r in kept] == ["clean", "clean"]


# --- main text

PAGE = """<html><body><header><h2>Site</h2></header><div id="menu">Home | About</div>
<div class="cookie-notice">We use cookies very much and you should accept them now</div>
<{0}><h1>Title here</h1><p>One two three four five six seven &eacute;t&eacute; &#8211; eight.</p>
<p>Nine <a href="x">ten</a> eleven<script>if (a<b) {{}}</script> twelve
<br>thirteen.<ul><li>point one is long enough</li><li>point two</li></ul>
<aside>See also this other thing</aside><p>Last paragraph with quite a few words here.</p>
<section class="reader comments"><article><p>I do not agree with this at all.</p></article>
</section></{0}><div id="sidebar"><p>Other articles you may like</p></div>
<form><input name=a><p>Sign up</p></form><footer>&copy; c</footer>"""
TEXT = "\n\n".join((
    "Title here", "One two three four five six seven été – eight.",
    "Nine ten eleven twelve thirteen.", "point one is long enough", "point two",
    "Last paragraph with quite a few words here."))


@pytest.mark.parametrize("element", ["article", "main", "div"])
def test_main_text(element):
    page = PAGE.format(element)
    assert html_text.main_text(page, html_text.DEFAULT_WEIGHTS) == TEXT
    assert html_text.main_text(page[:page.index("<form")], html_text.DEFAULT_WEIGHTS) == TEXT


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<p>", ""), ("plain text  here", "plain text here"), ("a < b and <3 c", "a < b and <3 c"),
    ("<script>x", ""), ("<!-- a -- b", ""), ("<p>a&amp;b &am c", "a&b &am c"),
    ("<div class='ad'>x y z</div>", ""), ("<p title=\"a > b\">long words inside here</p>",
                                          "long words inside here"),
    ("<div class='overflow-hidden'>some words</div><div hidden>no</div>", "some words")])
def test_odd_pages(page, text):
    assert html_text.main_text(page, html_text.DEFAULT_WEIGHTS) == text


@pytest.mark.parametrize("box", ["aside", "div class='newsletter'", "p class='advert'"])
def test_furniture_in_an_unmarked_article(box):
    weights = {"word": 12.0, "furniture": -12.8, "p": -3.0, "tag": -12.0}
    inside = f"<{box}>{'join our list ' * 20}</{box.split()[0]}>"
    page = (f"<ul><li>a<li>b<li>c</ul><div><p>one two three four five</p>{inside}"
            "<p>six seven eight nine</p></div><ul><li>d<li>e</ul>")
    assert html_text.main_text(page, weights) == "one two three four five\n\nsix seven eight nine"


MAIN = "<p>one two three four five six seven</p><p>eight nine ten eleven twelve</p>"
MAIN_TEXT = "one two three four five six seven\n\neight nine ten eleven twelve"
MENU = "<nav><ul><li><a>Home</a></li><li><a>About us</a></li></ul></nav>"
REPLY = "<section class='comments'><article><p>" + "such a long reply " * 9 + "</p></article></section>"


@pytest.mark.parametrize("name", [
    "has-sidebar", "no-sidebar", "content-with-sidebar", "no-comments", "share-enabled",
    "ad-free", "search-results", "related-off"])
@pytest.mark.parametrize("page", [
    f"<body>{MENU}<div class='@'><article>{MAIN}</article></div><footer>us</footer>",
    f"<body>{MENU}<article class='@'>{MAIN}</article>{REPLY}",
    f"<body>{MENU}<div class='@'>{MAIN}</div><footer>(c) us</footer></body>"])
def test_class_words_hide_no_article(name, page):
    weights = html_text.DEFAULT_WEIGHTS
    assert html_text.main_text(page.replace("@", name), weights) == MAIN_TEXT


@pytest.mark.parametrize("page", [
    f"<form>{MENU}<article>{MAIN}</article></form>", f"<form>{MENU}{MAIN}</form>",
    f"<nav><a>Home</a><article>{MAIN}</article>", f"{MENU}<main>{MAIN}</main>{REPLY}",
    f"{MENU}<div class='comments'><p>nice</p></div><article>{MAIN}</article>",
    f"{MENU}<article>{MAIN}<aside class='related'>read on</aside></article>{REPLY}{REPLY}"])
def test_wrapped_pages(page):
    assert html_text.main_text(page, html_text.DEFAULT_WEIGHTS) == MAIN_TEXT


@pytest.mark.parametrize("page", [
    f"{MENU}<div>{MAIN}</div>{REPLY}", f"{MENU}<div>{MAIN}</div>{REPLY}{REPLY}",
    f"<div>{MAIN}</div><section class='widget' id='comments'><article>{'so long ' * 20}</article>",
    f"{MENU}<div>{MAIN}</div><aside><article><p>read this one too</p></article></aside>",
    f"<form>{MENU}{MAIN}{REPLY}</form>", f"<div class='no-sidebar'>{MAIN}{REPLY}</div>"])
def test_articles_in_furniture_of_an_unmarked_page(page):
    assert html_text.main_text(page, html_text.DEFAULT_WEIGHTS) == MAIN_TEXT


@pytest.mark.parametrize("page", [
    f"<div class='modal'><article>{MAIN}</article></div><p>Skip it</p>",
    f"<aside><article>{MAIN}</article></aside>", f"<div id='comments'><article>{MAIN}</article></div>"])
def test_articles_in_furniture_of_a_page_without_more(page):
    assert html_text.main_text(page, html_text.DEFAULT_WEIGHTS) == MAIN_TEXT


def test_parsing_takes_time_in_proportion():
    def seconds(n):
        start = time.perf_counter()
        html_text.main_text("<div>" * n + "</span>" * n + "word", html_text.DEFAULT_WEIGHTS)
        return time.perf_counter() - start

    seconds(500)
    assert seconds(16_000) < 16 * max(seconds(2000), 0.01)


def test_best_run():
    rng = random.Random(4)
    for _ in range(200):
        scores = [rng.randrange(-4, 4) for _ in range(rng.randrange(12))]
        a, b = html_text.best_run(scores)
        every = [sum(scores[i:j]) for i in range(len(scores) + 1) for j in range(i, len(scores) + 1)]
        assert sum(scores[a:b]) == max(every)


@given
def test_pages_against_their_markup(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    weights = html_text.learn_weights(pages)
    assert weights["word"] > 0 and weights["li"] < 0 and weights["furniture"] < 0
    got = {r.page_id: r.text for r in html_text.extract(pages, weights).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*)</article>", r.html, re.DOTALL)[1]
        cut = re.split(r"</?(?:p|h1)>", inside)
        plain = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in cut]
        assert got[r.page_id] == "\n\n".join(x for x in plain if x)


def test_extract_handles_nulls(spark):
    pages = spark.createDataFrame(
        [(None, None, None), (1, "u", ""), (1, "u", "<p>a b c")],
        "page_id bigint, url string, html string").withColumn("text", F.lit("x"))
    assert html_text.learn_weights(pages) == html_text.DEFAULT_WEIGHTS
    rows = html_text.extract(pages, html_text.DEFAULT_WEIGHTS).collect()
    assert sorted(r.text for r in rows) == ["", "", "a b c"]
    assert html_text.extract(pages.limit(0), html_text.DEFAULT_WEIGHTS).count() == 0


# --- byte-level BPE


@vocabularies
def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = vocabulary_path("byte_bpe_50k.json")
    library, vocabulary = Tokenizer.from_file(path), bpe.Vocabulary(path)
    rng = random.Random(0)
    texts = ["", "  a  b\n\n c <|endoftext|> x<|endoftext|>", "a" * 4000, "<|endoftext|",
             "don't I'll 　x  y 123 ½ \U0001f389 \x00\x01", "\n\n\n", "'s 's a's ''s 'll've'reX",
             "'", "x'l", "it 'll\n 's", "<|endoftext|>" * 3, "äöü" * 3000]
    texts += ["a" + chr(c) + "b " + chr(c) * 2 + " c" for c in range(1, 0x500)]
    texts += ["".join(rng.choice("ab '\n\tst1.é") for _ in range(rng.randrange(60)))
              for _ in range(800)]
    rows = [*enumerate(texts), (None, None), (3, texts[3])]
    docs = spark.createDataFrame(rows, DOCS).withColumn("ids", F.lit("x"))
    got = bpe.round_trip(docs, vocabulary).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "" if r.doc_id is None else texts[r.doc_id]
        assert r.ids == library.encode(text, add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False) == text
    assert bpe.encode(docs.limit(0), vocabulary).count() == 0
    coded = spark.createDataFrame([(1, [15496, None, -5, 10**6]), (2, None), (3, [158])],
                                  "doc_id bigint, ids array<int>")
    assert sorted(map(tuple, bpe.decode(coded, vocabulary).collect())) == [
        (1, "Hello"), (2, ""), (3, "�")]


# --- preferences


def test_preferences(spark):
    rows = [(1, "chosen", 0, "user", "hi"), (1, "chosen", 1, "assistant", "yes"),
            (1, "rejected", 0, "user", "hi"), (1, "rejected", 1, "assistant", "no"),
            (1, "rejected", 2, "user", None), (2, "chosen", 0, None, "<|end|>"),
            (3, "chosen", 0, "user", "a"), (3, "rejected", 0, "user", "a"),
            (4, "rejected", None, "assistant", "late"), (4, "rejected", 5, "user", "b"),
            (4, "rejected", 5, "user", "a"), (None, "chosen", 0, "user", "x"), (5, "other", 0, "u", "")]
    turns = spark.createDataFrame(
        rows, "pair_id bigint, side string, turn bigint, role string, text string"
    ).withColumns({c: F.lit(1) for c in ("part", "prompt", "chosen", "end")})
    got = {r.pair_id: r for r in chat.format_preferences(turns).where("part < 1").collect()}
    one = got[1]
    assert (one.prompt_turns, one.prompt) == (1, "<|user|>\nhi<|end|>\n")
    assert one.chosen == "<|assistant|>\nyes<|end|>\n" and one.chosen_mask == "-14 +11"
    assert one.rejected_mask == "-14 +10 -9 -8"
    assert got[2].chosen == "<|unknown|>\n< |end|><|end|>\n" and got[2].rejected == ""
    assert (got[3].prompt_turns, got[3].chosen, got[3].rejected) == (1, "", "")
    assert got[4].rejected == "<|user|>\na<|end|>\n<|user|>\nb<|end|>\n"
    assert set(got) == {1, 2, 3, 4}
    late = chat.format_preferences(turns).where("part >= 1").collect()
    assert [r.rejected for r in late] == ["<|assistant|>\nlate<|end|>\n"]
    parts = chat.format_preferences(turns.where("pair_id = 1"), part_turns=1)
    assert [r.rejected for r in parts.orderBy("part").collect()] == [
        "", "<|assistant|>\nno<|end|>\n", "<|user|>\n<|end|>\n"]
    assert chat.format_preferences(turns.limit(0)).count() == 0


def test_swapped_replies(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "one"), (2, 0, "user", "r"),
            (2, 1, "assistant", "two"), (3, 0, "user", "alone"), (None, 0, "assistant", "x"),
            (7, 0, "assistant", None)]
    talk = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.pair_id, r.side, r.turn): r.text for r in chat.with_swapped_replies(talk).collect()}
    assert got[1, "rejected", 1] == "two" and got[1, "chosen", 1] == "one"
    assert got[2, "rejected", 1] == "one" and got[7, "rejected", 0] == "one"
    assert {k[0] for k in got} == {1, 2, 7}
    assert chat.with_swapped_replies(talk.limit(0)).count() == 0


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None},
    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}},
    {"added_tokens": [{"id": 0, "content": "a", "lstrip": True}]},
    {"model": {"type": "WordPiece", "vocab": {}}}])
def test_other_vocabularies_are_refused(tmp_path, change):
    plain = {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False},
             "model": {"type": "BPE", "vocab": {}, "merges": []}}
    (tmp_path / "v.json").write_text(json.dumps(plain | change))
    with pytest.raises(ValueError, match="plain byte-level"):
        bpe.Vocabulary(str(tmp_path / "v.json"))
