"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_split(value: Column, sep: str = " ") -> Column:
    """Split as JVM programs do: leading and inner empties stay, trailing ones go; '' gives ['']."""
    if len(sep) != 1:
        raise ValueError("sep is one character")
    stripped = F.rtrim(value, F.lit(sep))
    only_sep = (F.length(value) > 0) & (stripped == "")
    pattern = sep if sep == " " or sep.isalnum() else "\\" + sep
    return F.when(only_sep, F.array().cast("array<string>")).otherwise(F.split(stripped, pattern))


def hashtags(text: Column, strip: bool = False) -> Column:
    """Blank-separated tokens that start with '#', with or without the sign."""
    tags = F.filter(F.split(text, " "), lambda t: t.startswith("#"))
    return F.transform(tags, lambda t: F.substring(t, 2, 2147483647)) if strip else tags


def char_ngrams(text: Column) -> Column:
    """Sliding character pairs; one character gives itself, the empty string gives nothing.

    One pass over the text, linear in its length: each match captures two characters ahead and
    moves on by one.
    """
    return F.when(F.length(text) == 1, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit("(?s)(?=(..))."), 1))


def normalize_text(text: Column) -> Column:
    """Lower case; runs of one character longer than two are cut to two."""
    return F.regexp_replace(F.lower(text), r"(?s)(.)\1{2,}", "$1$1")


def tokens(text: Column) -> Column:
    """Words and hashtags of a normalised text."""
    return F.filter(F.split(text, r"[^\p{L}#]+"), lambda t: t != "")


def ngrams(words: Column, n: int = 2) -> Column:
    """Phrases of n successive words."""
    size = F.size(words)
    grams = F.slice(words, 1, size - (n - 1))
    for i in range(1, n):
        grams = F.zip_with(grams, F.slice(words, 1 + i, size - (n - 1)),
                           lambda a, b: F.concat_ws(" ", a, b))
    return F.when(size < n, F.array().cast("array<string>")).otherwise(grams)


def after_last_dot(value: Column) -> Column:
    return F.substring_index(value, ".", -1)
