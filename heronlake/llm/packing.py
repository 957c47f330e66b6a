"""Best-fit packing of whole documents into sequences of a fixed number of tokens, with large items matched first.

A document is its token ids and an end id. Only longer ones are cut: the first piece takes what is left over, the others
are full. Pieces longer than a third of a sequence can stand at most two to a sequence; they are matched greedily, the
longest with the longest that still fits. Shorter pieces then go, longest first, to the sequence with the least gap
that holds them.

Lengths are whole numbers up to the capacity, so this plan needs only the number of pieces of each length: it is made on
the driver from one count per length and consists of runs ("pieces number a to b of length n stand in sequences c to d
at offset o"). The tasks number the pieces of each length (a running number per task, and the totals of the tasks
before) and look their places up. The plan has at most a few rows per pair of length and gap, whatever the corpus.

Defined cases: null text is the empty text, a piece of one end id; repeated rows are packed separately; a null id is kept;
an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heronlake.llm.common import strings
from heronlake.session import settle

CAPACITY = 1024
END_ID = 2
#: Words whose ids a worker remembers.
REMEMBERED = 300_000


class Encoder:
    """Ids of the byte-level tokenizer in `name`.json, with the ids of frequent words remembered.

    A blank between other characters always starts a new word of this tokenizer, so the ids of a text are those of its
    parts between blanks. Texts where a blank stands between or after other white space go through whole.
    """

    SPECIAL = "<|endoftext|>"
    ODD = re.compile(r"\s (?!\S)")

    def __init__(self, name: str = "byte_bpe_50k", folder: str | None = None) -> None:
        import base64
        import os

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        place = (lambda f: os.path.join(folder, f)) if folder else public_tokenizers.path
        self.whole = Tokenizer.from_file(place(f"{name}.json"))
        with open(place(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                ids = np.array(fast.encode_ordinary(" " + word), "<u4").tobytes()
                if len(self) < REMEMBERED:
                    self[word] = ids
                return ids

        self.fast, self.words = fast, Words()

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.SPECIAL in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if "  " in text or self.ODD.search(text):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        return np.array(self.fast.encode_ordinary(first), "<u4").tobytes() + b"".join(map(self.words.__getitem__, rest))


_encoders: dict[tuple, Encoder] = {}


def encoder(name: str, folder: str | None) -> Encoder:
    """One per worker process."""
    if (name, folder) not in _encoders:
        _encoders[name, folder] = Encoder(name, folder)
    return _encoders[name, folder]


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: what is left over first, then full ones."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, block long, number long"


def pieces(documents: DataFrame, capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """Every piece with a running number among the pieces of its length in its block (the task that made it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, block = encoder(tokenizer, folder), TaskContext.get().partitionId()
        numbers = np.zeros(capacity + 1, np.int64)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                ids = encode.ids(text) + end
                for i, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((doc_id, i, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), block, numbers[length]))
                    numbers[length] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "piece" else pa.int64())
                                                  for n, c in zip(NAMES, zip(*out))], NAMES)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


NAMES = [x.split()[0] for x in PIECES.split(", ")]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first, count, sequence, each, offset): item first + i of this length stands in sequence
    sequence + i // each at offset + (i % each) * length. Sequences are numbered from 0.
    """
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, number of sequences)
    sequences = 0
    left, done = dict(counts), dict.fromkeys(counts, 0)

    def put(length: int, count: int, sequence: int, each: int, offset: int) -> None:
        runs.append((length, done[length], count, sequence, each, offset))
        done[length] += count
        left[length] -= count

    def gap(size: int, sequence: int, count: int) -> None:
        if size and count:
            gaps.setdefault(size, []).append((sequence, count))

    large = sorted((n for n in counts if 3 * n > capacity), reverse=True)
    for a in large:
        while left[a]:
            b = next((n for n in large if n <= a and a + n <= capacity and left[n] > (n == a)), None)
            if b is None:
                n = left[a]
                put(a, n, sequences, 1, 0)
                gap(capacity - a, sequences, n)
            elif b == a:
                n = left[a] // 2
                put(a, 2 * n, sequences, 2, 0)
                gap(capacity - 2 * a, sequences, n)
            else:
                n = min(left[a], left[b])
                put(a, n, sequences, 1, 0)
                put(b, n, sequences, 1, a)
                gap(capacity - a - b, sequences, n)
            sequences += n

    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        for size in sorted(g for g in gaps if g >= length):
            each = size // length
            waiting = gaps.pop(size) if left[length] else []
            while waiting and left[length]:
                sequence, count = waiting.pop()
                full = min(count, left[length] // each)
                if full:
                    put(length, full * each, sequence, each, capacity - size)
                    gap(size - each * length, sequence, full)
                rest = left[length]
                if full < count:
                    if rest:  # fewer than fill one more sequence
                        put(length, rest, sequence + full, rest, capacity - size)
                        gap(size - rest * length, sequence + full, 1)
                        full += 1
                    gap(size, sequence + full, count - full)
            for sequence, count in waiting:
                gap(size, sequence, count)
            if not left[length]:
                break
        each = capacity // length
        if full := left[length] // each:
            put(length, full * each, sequences, each, 0)
            gap(capacity - each * length, sequences, full)
            sequences += full
        if rest := left[length]:
            put(length, rest, sequences, rest, 0)
            gap(capacity - rest * length, sequences, 1)
            sequences += 1
    return np.array(sorted(runs), np.int64).reshape(-1, 6)


def numbered(made: DataFrame) -> DataFrame:
    """Adds `item`, the number of a piece among all pieces of its length."""
    totals = made.groupBy("length", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("length").alias("t_length"), F.col("block").alias("t_block"),
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return (made.join(totals, (F.col("length") == F.col("t_length")) & (F.col("block") == F.col("t_block")))
            .withColumn("item", F.col("before") + F.col("number")))


def pack(documents: DataFrame, capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    made = settle(pieces(documents, capacity, tokenizer, folder), "pack-pieces")
    counts = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}  # one number per length
    runs = plan(counts, capacity)
    keys = (runs[:, 0] << 48) | runs[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, item = batch.column("length").to_numpy(), batch.column("item").to_numpy()
            _, first, _, sequence, each, offset = runs[np.searchsorted(keys, (length << 48) | item, side="right") - 1].T
            i = item - first
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")],
                 pa.array(sequence + i // np.maximum(each, 1)), pa.array(offset + i % np.maximum(each, 1) * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    found = numbered(made).select("doc_id", "piece", "start", "length", "ids_crc32", "item")
    return found.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
