"""Word counts and phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.functions.text import hashtags, java_split, ngrams, normalize_text, tokens


def tokenize(df: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    """One row per word; the other columns stay."""
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, F.explode(java_split(F.col(col), sep)).alias("word"))


def long_words(words: DataFrame, min_len: int = 4) -> DataFrame:
    return words.filter(F.length("word") > min_len)


def word_count(words: DataFrame, by=()) -> DataFrame:
    return words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The k rows with the largest `by`; equal ones by `tie` ascending."""
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)


def tag_rows(df: DataFrame, col: str = "text", strip: bool = False) -> DataFrame:
    """One row per hashtag; the other columns stay."""
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, F.explode(hashtags(F.col(col), strip)).alias("tag"))


# Frequent function words dropped before phrases are built.
STOPWORDS = ["the", "of", "and", "to", "in", "is", "on", "by", "with", "as", "at", "le", "la", "les",
             "de", "des", "et", "un", "une", "der", "die", "das", "und", "ein", "el", "los", "y", "en"]


def phrases(df: DataFrame, col: str, n: int = 2, stopwords=tuple(STOPWORDS)) -> DataFrame:
    """One row per phrase of n words of the normalised text, without stop words; hashtags count as words."""
    keep = [c for c in df.columns if c != col]
    words = F.filter(tokens(normalize_text(F.col(col))), lambda w: ~w.isin(*stopwords))
    return df.select(*keep, words.alias("_words")).select(
        *keep, F.explode(ngrams(F.col("_words"), n)).alias("phrase"))
