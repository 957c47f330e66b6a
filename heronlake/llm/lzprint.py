"""Lempel-Ziv phrase fingerprints of documents.

A text is parsed left to right into the shortest phrases not met before (LZ78, over code points, one dictionary per text).
The set of phrases, hashed to 32 bits, is the fingerprint's set; the fingerprint is the `size` least hashes of it, base64 of
big-endian words in ascending order. Two fingerprints are compared by the share of common hashes among the `size` least of
their union, which estimates the Jaccard similarity of the phrase sets (and is exact for sets of up to `size` phrases).

`edit_test` puts beside every document its edited text (the last half replaced by the start of the next document,
descending id; after the last comes the first) and compares. Documents are dealt to ranges of ids, whose borders come from
approximate quantiles; the first document of a range is copied to the range above, so neighbours always meet, and
every text is moved once. A task holds two documents at a time.

Defined cases: null text is the empty text; the empty text has the empty fingerprint, which is like another empty one (1)
and unlike all others (0); a null id comes after all others; rows of the same id follow each other in order of text; a
single document is its own neighbour; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.llm.common import strings

SIZE = 64
#: Ranges of ids per shuffle partition, so that hashing them to partitions evens out.
RANGES_PER_PARTITION = 4
LEAST_ID = -(1 << 63)


def parse(text: str, phrases: set[str], phrase: str = "") -> tuple[list[str], str]:
    """New phrases of the text, added to the dictionary, and the unfinished phrase at its end (a known one)."""
    found = []
    for ch in text:
        phrase += ch
        if phrase not in phrases:
            phrases.add(phrase)
            found.append(phrase)
            phrase = ""
    return found, phrase


def least(hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    if len(hashes) > 4 * size:
        cut = min(len(hashes) - 1, 2 * size)
        small = np.unique(np.partition(hashes, cut)[:cut])
        if len(small) >= size:
            return small[:size]
    return np.unique(hashes)[:size]


def hashed(phrases: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh32_intdigest, phrases), np.uint32, len(phrases))


def encode(print_: np.ndarray) -> str:
    return base64.b64encode(print_.astype(">u4").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Share of common hashes among the `size` least of the union; 1 for two empty sets."""
    x, y = set(a.tolist()), set(b.tolist())
    union = sorted(x | y)[:size]
    return sum(h in x and h in y for h in union) / len(union) if union else 1.0


class Parsed:
    """A parsed text that can be parsed again with another second half."""

    def __init__(self, text: str, size: int = SIZE) -> None:
        self.text, self.size = text, size
        self.cut = len(text) - len(text) // 2
        self.phrases: set[str] = set()
        found, self.open = parse(text[:self.cut], self.phrases)
        self.head = least(hashed(found), size)
        rest, _ = parse(text[self.cut:], self.phrases, self.open)
        self.phrases.difference_update(rest)
        self.print = least(np.concatenate([self.head, hashed(rest)]), size)

    def edited(self, other: str) -> tuple[str, np.ndarray]:
        """The text with its last half replaced by the start of another, and its fingerprint. Uses the dictionary up."""
        tail = other[:len(self.text) // 2]
        rest, _ = parse(tail, self.phrases, self.open)
        return self.text[:self.cut] + tail, least(np.concatenate([self.head, hashed(rest)]), self.size)


def fingerprint(text: str, size: int = SIZE) -> str:
    return encode(least(hashed(parse(text, set())[0]), size))


def fingerprints(documents: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id and fingerprint of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([fingerprint(t, size) for t in strings(batch.column(1))], pa.string())],
                ["doc_id", "fingerprint"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def in_ranges(documents: DataFrame) -> DataFrame:
    """(part, tail, key, doc_id, text): documents by range of ids, each range followed by the first row of the next lower one."""
    spark = documents.sparkSession
    count = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("key"),
                            F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select("key")
    quantiles = ids.approxQuantile("key", [i / count for i in range(1, count)], 0.25 / count)
    borders = np.unique(np.array([int(q) for q in quantiles], np.int64))

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, key.to_numpy(np.int64), side="right").astype(np.int32))

    heads = sorted(((r["part"], r["head"]) for r in ids.groupBy(part_of("key").alias("part"))
                    .agg(F.max("key").alias("head")).collect()), reverse=True)  # one number per range
    above = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}  # the last range gets the first document of all

    @F.pandas_udf("array<int>")
    def parts_of(key: pd.Series) -> pd.Series:
        own = np.searchsorted(borders, key.to_numpy(np.int64), side="right")
        return pd.Series([[int(p), above[k]] if k in above else [int(p)] for k, p in zip(key, own)])

    dealt = rows.withColumn("parts", parts_of("key")).select(F.posexplode("parts").alias("tail", "part"), "key", "doc_id", "text")
    return (dealt.repartition("part")
            .sortWithinPartitions("part", "tail", F.col("key").desc(), "text"))


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edit_test(documents: DataFrame, size: int = SIZE) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = last_id = None
        last: Parsed | None = None
        for batch in batches:
            out: list[tuple] = []
            for p, tail, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("part", "tail", "doc_id", "text")]):
                if p != part:
                    part, last = p, None
                if tail and last is None:
                    continue  # of several copied rows with one id only the first is a neighbour
                now = Parsed(text, size)
                if last is not None:
                    edited, other = last.edited(text)
                    out.append((last_id, len(last.text), hashlib.sha256(edited.encode()).hexdigest(), encode(last.print),
                                encode(other), likeness(last.print, other, size), likeness(last.print, now.print, size)))
                last, last_id = (None, None) if tail else (now, doc_id)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES)], NAMES)

    return in_ranges(documents).select("part", "tail", "doc_id", "text").mapInArrow(run, RESULT)


NAMES = [x.split()[0] for x in RESULT.split(", ")]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
