"""The text normalizer as Spark column expressions.

Documents and queries go through the same chain. Every step is a built-in
expression, so a whole chain compiles into one generated stage and never
leaves the JVM. Line-oriented and position-sensitive quirks that search
results depend on are kept:

* a digit removes the rest of its line, not only the number;
* stop words go only where a space stands on both sides, so those at the start
  or end of a line stay, and of two equal neighbors one stays;
* a separator at the very start leaves an empty first token, which counts as a
  position and in the document length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters to delete and the stop words, in the order in
# which they are applied.
PUNCTUATION = "`&'*\\{}[]:,!><#()%.+?\";/^|~$"
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he",
    "in", "is", "it", "its", "of", "on", "that", "the", "to", "was", "were",
    "will", "with",
)

# Characters up to U+0020, which Java's trim() removes (Spark's removes spaces).
CONTROL_AND_SPACE = "".join(chr(code) for code in range(0x21))

TOKEN_SEPARATOR = "::"

DIGIT_MODES = ("line", "token")


def strip_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def _digit_tail(digits: str) -> str:
    if digits not in DIGIT_MODES:
        raise ValueError(f"digits must be one of {DIGIT_MODES}, not {digits!r}")
    return r"\d+.*" if digits == "line" else r"\d+[^ \n\t\r-]*"


def strip_digits(text: Column, digits: str = "line") -> Column:
    """``line`` deletes from the first digit to the end of the line, ``token``
    from the first digit to the end of the word."""
    return F.regexp_replace(text, _digit_tail(digits), "")


def lowercase(text: Column) -> Column:
    return F.lower(text)


def remove_stop_words(text: Column) -> Column:
    return reduce(
        lambda c, word: F.replace(c, F.lit(f" {word} "), F.lit(" ")), STOP_WORDS, text
    )


def hyphens_to_spaces(text: Column) -> Column:
    return F.regexp_replace(text, "-+", " ")


def collapse_separators(text: Column) -> Column:
    return F.regexp_replace(text, r"[ \n\t\r]+", TOKEN_SEPARATOR)


def java_trim(text: Column) -> Column:
    return F.btrim(text, F.lit(CONTROL_AND_SPACE))


def normalize(text: Column, digits: str = "line") -> Column:
    """The whole chain: tokens of ``text`` joined by ``::``.

    Steps that cannot affect each other share a pass: punctuation with digits
    (neither deletes what the other looks for), and hyphens with separators
    (both end in ``::``).
    """
    punctuation = "".join(rf"\{c}" for c in PUNCTUATION)
    text = F.regexp_replace(text, rf"[{punctuation}]|{_digit_tail(digits)}", "")
    text = remove_stop_words(lowercase(text))
    return java_trim(F.regexp_replace(text, r"[- \n\t\r]+", TOKEN_SEPARATOR))


def clean_tokens(normalized: Column) -> Column:
    """Trim control characters around each token of a normalized text.

    Only the rare text that holds one pays for the replacement. Refer to a
    materialized column: ``normalized`` is used twice.
    """
    controls = r"[\x00-\x20]"
    return F.when(
        normalized.rlike(controls),
        F.regexp_replace(
            normalized, f"{controls}*{TOKEN_SEPARATOR}{controls}*", TOKEN_SEPARATOR
        ),
    ).otherwise(normalized)


def split_tokens(normalized: Column) -> Column:
    """Split like Java: the text's own trailing separator opens no token, a
    leading one opens an empty token, and a bare separator holds none."""
    return F.when(
        normalized == TOKEN_SEPARATOR, F.array().cast("array<string>")
    ).otherwise(
        F.split(
            F.when(
                F.endswith(normalized, F.lit(TOKEN_SEPARATOR)),
                F.left(normalized, F.char_length(normalized) - len(TOKEN_SEPARATOR)),
            ).otherwise(normalized),
            TOKEN_SEPARATOR,
        )
    )


def same_term(left: Column, right: Column) -> Column:
    """Case-insensitive equality after trimming."""
    return F.lower(java_trim(left)) == F.lower(java_trim(right))
