"""From documents to training sequences: five operators, each stage written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.llm import jaccard, langid, lines, mixing, packing
from heronlake.session import prepare, settle
from heronlake.sources.tables import table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language go."""
    return langid.known_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go but for their first occurrence, and with them documents of which nothing else is left."""
    cleaned = lines.without_boilerplate(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    kept = cleaned.filter(~F.coalesce(emptied, F.lit(False)))

    def column(name: str):
        before = F.col("doc").getField(name)
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(before).alias(name)
        return before.alias(name)

    return kept.select(*[column(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates (five-word shingles, similarity 0.8) the document with the least id stays."""
    return jaccard.one_of_each(docs, jaccard.NEAR)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return packing.pack(docs)


STAGES = [("language_id", language), ("line_dedup", line_dedup), ("ngram_jaccard", near_duplicates),
          ("source_mixing", mixture), ("best_fit_packing", sequences)]

#: Language profiles, tokens and the packing plan are beyond SQL; tests/llm compares with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir.rstrip("/"), "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
