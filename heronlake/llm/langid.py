"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram is bound as the product of its
letters' vectors, the first rolled by two places, the second by one. A document is the bundle (sum) of the vectors of all
its trigrams, a language the bundle of its documents at unit length, less the mean of all languages. The answer is the
language whose profile has the greatest cosine with the document.

Profiles are fitted on a bounded sample of labelled rows: at most `per_language` of each language, those with the least
hash of their id. Prediction is one pass over all documents without a shuffle.

Text is lower-cased letter by letter; every run of other characters is one blank. Defined cases: null text or text without
a letter gives `und` with score 0; without labelled rows everything is `und`; the score is the cosine, 0 if negative;
of equal cosines the language that comes first by code point wins; repeated rows are predicted alike; an empty table
gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heronlake.llm.common import crc_fold, groups, strings

BLANK = 32


@dataclass(frozen=True)
class Settings:
    """per_language bounds the labelled rows of a language that its profile is made of."""

    dimension: int = 512
    per_language: int = 1_000
    seed: int = 11
    folds: int = 4
    held_fold: int = 2
    enough: int = 100
    least_score: float = 0.1


@dataclass
class Profiles:
    names: list[str]
    mean: np.ndarray
    vectors: np.ndarray  # one row of unit length per language


@functools.lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Code point -> lower-case code point for letters, a blank for all others."""
    out = np.full(0x110000, BLANK, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


@functools.lru_cache(maxsize=20_000)
def letter_vector(code: int, dimension: int, seed: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64([seed, code])).integers(0, 2, dimension)
    return (bits * 2 - 1).astype(np.float32)


def letters(text: str) -> np.ndarray:
    """Code points of the text's letters in lower case, runs of others as one blank, a blank at either end."""
    codes = letter_table()[np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = codes == BLANK
    return codes[~(blank & np.concatenate([[False], blank[:-1]]))]


def bundle(texts: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of the texts, their lengths in letters and single blanks, 0 without a letter). Memory follows the distinct
    trigrams of the texts."""
    coded = [letters(t) for t in texts]
    size_of = np.array([len(c) - 1 for c in coded], np.int64)  # a text without a letter is one blank
    out = np.zeros((len(texts), s.dimension), np.float32)
    if not size_of.any():
        return out, size_of
    alphabet, codes = np.unique(np.concatenate(coded), return_inverse=True)
    size = np.int64(len(alphabet))
    owner = np.repeat(np.arange(len(texts)), [len(c) for c in coded])
    inside = owner[2:] == owner[:-2]
    gram = ((codes[:-2] * size + codes[1:-1]) * size + codes[2:])[inside]
    if size ** 3 <= 1 << 21:
        seen = np.flatnonzero(np.bincount(gram, minlength=size ** 3))
        places = np.zeros(size ** 3, np.int64)
        places[seen] = np.arange(len(seen))
        gram = places[gram]
    else:
        seen, gram = np.unique(gram, return_inverse=True)
    basis = np.stack([letter_vector(int(c), s.dimension, s.seed) for c in alphabet])
    owner = owner[2:][inside]
    for part in range(0, len(seen), 16_384):  # bounds the matrices for texts with very many distinct trigrams
        g = seen[part:part + 16_384]
        vectors = (np.roll(basis, 2, axis=1)[g // (size * size)] * np.roll(basis, 1, axis=1)[g // size % size]
                   * basis[g % size])
        own = (gram >= part) & (gram < part + len(g)) if len(seen) > 16_384 else slice(None)
        counts = np.bincount(owner[own] * len(g) + gram[own] - part, minlength=len(texts) * len(g))
        out += counts.reshape(len(texts), len(g)).astype(np.float32) @ vectors
    return out, size_of


def unit(v: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(v, axis=-1, keepdims=True)
    return v / np.where(length > 0, length, 1)


def sample_rows(documents: DataFrame, s: Settings) -> DataFrame:
    """(s_doc_id, s_lang) of the per_language ids with the least hashes of each language. Ids above a hash that leaves about four
    times as many go first, so that few rows of a language are ranked together, however many it has."""
    rows = (documents.select("doc_id", "lang").filter("lang IS NOT NULL AND doc_id IS NOT NULL")
            .filter(crc_fold("doc_id", s.folds) != s.held_fold))
    ids = rows.groupBy(F.col("lang").alias("of")).agg(F.approx_count_distinct("doc_id").alias("ids"))
    share = F.least(F.lit(4.0 * s.per_language) / F.col("ids"), F.lit(1.0))
    bounds = ids.select("of", (F.lit(-2.0 ** 63) + share * F.lit(2.0 ** 64)).alias("bound"))
    # one row per language, as in the profiles
    few = (rows.join(F.broadcast(bounds), F.col("lang") == F.col("of"))
           .filter(F.xxhash64("doc_id").cast("double") <= F.col("bound")).select("doc_id", "lang").distinct())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    return (few.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= s.per_language)
            .select(F.col("doc_id").alias("s_doc_id"), F.col("lang").alias("s_lang")))


def fit(documents: DataFrame, s: Settings = Settings()) -> Profiles:
    """Only one vector per language reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), strings(batch.column(1))
            for part in groups(texts):
                vectors, _ = bundle(texts[part], s)
                for lang, v in zip(langs[part], unit(vectors)):
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "v"])

    # the sample is bounded: per_language rows of an id and a name for each language
    rows = documents.select("doc_id", "lang", "text").join(
        F.broadcast(sample_rows(documents, s)), (F.col("doc_id") == F.col("s_doc_id")) & (F.col("lang") == F.col("s_lang")))
    sums = (rows.select("lang", "text").mapInArrow(run, "lang string, v array<double>")
            .select("lang", F.posexplode("v").alias("place", "value"))
            .groupBy("lang", "place").agg(F.sum("value").alias("value"))
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v")).collect())
    found = sorted((r["lang"], np.array([x["value"] for x in r["v"]])) for r in sums) if sums else []
    names = [n for n, _ in found]
    raw = unit(np.stack([v for _, v in found])) if found else np.zeros((0, s.dimension))
    mean = raw.mean(axis=0) if len(found) > 1 else np.zeros(s.dimension)
    return Profiles(names, mean, unit(raw - mean))


def with_language(documents: DataFrame, p: Profiles, s: Settings = Settings(), whole: str | None = None) -> DataFrame:
    """The documents with _lang, _score and _letters (letters and single blanks between them) added; whole: the column that
    holds the rows as structs, if they are packed."""
    names, at = p.names, documents.columns.index(whole or "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column(at).field("text") if whole else batch.column(at))
            best, cosines, lengths = [], [], []
            for part in groups(texts, 1 << 19):
                vectors, size = bundle(texts[part], s)
                if names:
                    cos = unit(unit(vectors.astype(np.float64)) - p.mean) @ p.vectors.T
                    top = cos.argmax(axis=1)
                    value = np.clip(cos[np.arange(len(top)), top], 0, 1)
                for i, n in enumerate(size.tolist()):
                    known = n > 0 and bool(names)
                    best.append(names[top[i]] if known else "und")
                    cosines.append(float(value[i]) if known else 0.0)
                    lengths.append(n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.string()), pa.array(cosines, pa.float64()), pa.array(lengths, pa.int64())],
                [*batch.schema.names, "_lang", "_score", "_letters"])

    schema = T.StructType([*documents.schema.fields, T.StructField("_lang", T.StringType()),
                           T.StructField("_score", T.DoubleType()), T.StructField("_letters", T.LongType())])
    return documents.mapInArrow(run, schema)


def predict(documents: DataFrame, p: Profiles, s: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    found = with_language(documents.select(F.col("doc_id").cast("long"), "text"), p, s)
    return found.select("doc_id", (crc_fold("doc_id", s.folds) == s.held_fold).alias("held_out"),
                        F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))


def identify(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    return predict(documents, fit(documents, s), s)


def known_language(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents without those of no known language: texts without a letter, and texts of at least `enough` letters that
    are like no profile (score below least_score). Short texts are too noisy to be judged by score."""
    # the row goes along as one value, so that columns of any name do no harm
    packed = documents.select(F.struct(*documents.columns).alias("doc"))
    found = with_language(packed, fit(documents, s), s, "doc")
    unlike = (F.col("_letters") >= s.enough) & (F.col("_score") < s.least_score)
    return found.filter((F.col("_lang") != "und") & ~unlike).select("doc.*")
