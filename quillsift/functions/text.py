"""Column expressions on one text. Everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsift.functions.charsets import BLANK_CLASS, BLANKS, SEPARATOR_CLASS

HTTP_PATTERN = r"(?iu)https?://"
# Java's \b knows ASCII only, so the word boundary is spelled out.
# The look-behind follows the first letter, so it runs only where that letter is.
WEB_PATTERN = r"(?iu)w(?<![\p{L}\p{N}_]w)ww\.[a-z0-9]+\.[a-z]{2,}"
SUBJECT_PATTERN = r"(?iu)^Subject:"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def word_count(text: Column) -> Column:
    words = F.size(F.split(strip(text), f"[{BLANK_CLASS}]+"))
    return F.when(is_blank(text), 0).otherwise(words).cast("bigint")


def plain_separators(text: Column) -> Column:
    return F.regexp_replace(text, f"[{SEPARATOR_CLASS}]", " ")


def ascii_count(text: Column, char_class: str) -> Column:
    """Number of ASCII characters of a class: bytes lost when they are removed."""
    rest = F.regexp_replace(text, f"[{char_class}]+", "")
    return (F.octet_length(text) - F.octet_length(rest)).cast("bigint")


def char_count(text: Column, char: str) -> Column:
    """Number of times one ASCII character occurs, without a regular expression."""
    rest = F.replace(text, F.lit(char), F.lit(""))
    return (F.octet_length(text) - F.octet_length(rest)).cast("bigint")


def without_lower(text: Column) -> Column:
    return F.regexp_replace(text, "[a-z]+", "")


def punctuation(text: Column) -> Column:
    """The ASCII punctuation of a text, in order."""
    return F.regexp_replace(text, r"[^!-/:-@\[-`{-~]+", "")


def digit_count(text: Column) -> Column:
    rest = F.regexp_replace(text, r"\p{Nd}+", "")
    return (F.char_length(text) - F.char_length(rest)).cast("bigint")


def share(part: Column, whole: Column) -> Column:
    """Ratio that is 0 where the whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def joined_text(subject: str = "Subject", body: str = "Body") -> Column:
    return F.concat(F.col(subject), F.lit(" "), F.col(body))


def row_hash(seed: int, *keys: str) -> Column:
    """Order of rows that depends on nothing but the seed and the row key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
