"""Hashed counts of character pairs as a pipeline stage.

The numbers are those of Spark's HashingTF over the sliding pairs of a text (one character gives itself), worked out for many
texts at a time, without a string for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasNumFeatures, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters that are worked on at a time (a longer text is one piece).
CHARS = 1 << 20
#: Pairs of code points below this have their buckets in a table.
TABLE = 384
#: HashingTF's seed.
SEED = 42


def _utf8(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of code points as little-endian numbers, and how many there are."""
    code = code.astype(np.uint64)
    last = lambda shift: ((code >> np.uint64(shift)) & np.uint64(63)) | np.uint64(0x80)
    size = 1 + (code >= 0x80).astype(np.uint64) + (code >= 0x800) + (code >= 0x10000)
    two = (code >> np.uint64(6) | np.uint64(0xC0)) | last(0) << np.uint64(8)
    three = (code >> np.uint64(12) | np.uint64(0xE0)) | last(6) << np.uint64(8) | last(0) << np.uint64(16)
    four = (code >> np.uint64(18) | np.uint64(0xF0)) | last(12) << np.uint64(8) | last(6) << np.uint64(16) | last(0) << np.uint64(24)
    return np.choose(size.astype(np.int64) - 1, [code, two, three, four]), size


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint32(bits) | x >> np.uint32(32 - bits)


def _mixed_word(word: np.ndarray) -> np.ndarray:
    return _turned(word * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)


def _with_word(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _turned(h ^ _mixed_word(word), 13) * np.uint32(5) + np.uint32(0xE6546B64)


def murmur3(data: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Murmur3 (32 bits) of strings of up to 8 bytes, given as little-endian numbers, as signed numbers."""
    low, high = data.astype(np.uint32), (data >> np.uint64(32)).astype(np.uint32)
    h = np.full(len(data), SEED, np.uint32)
    long = size >= 4
    h = np.where(long, _with_word(h, low), h)
    rest, left = np.where(long, high, low), np.where(long, size - np.uint64(4) * long, size)
    h = np.where(left == 4, _with_word(h, rest), h ^ _mixed_word(rest))
    h = h ^ size.astype(np.uint32)
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return (h ^ h >> np.uint32(16)).view(np.int32)


def single_buckets(code: np.ndarray, buckets: int) -> np.ndarray:
    return murmur3(*_utf8(code)).astype(np.int64) % buckets


def pair_buckets(first: np.ndarray, second: np.ndarray, buckets: int) -> np.ndarray:
    (a, size), (b, more) = _utf8(first), _utf8(second)
    return murmur3(a | b << (np.uint64(8) * size), size + more).astype(np.int64) % buckets


@lru_cache(maxsize=4)
def _table(buckets: int) -> np.ndarray:
    first, second = np.divmod(np.arange(TABLE * TABLE), TABLE)
    return pair_buckets(first, second, buckets)


def _pieces(texts: list[bytes]) -> Iterator[list[bytes]]:
    piece, chars = [], 0
    for text in texts:
        if piece and chars + len(text) > CHARS:
            yield piece
            piece, chars = [], 0
        piece.append(text)
        chars += len(text)
    if piece:
        yield piece


def counted(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of UTF-8 texts: non-empty buckets of each text, one after the other, their counts, and the number of them per text."""
    wide = [text.decode("utf-8", "replace").encode("utf-32-le") for text in texts]
    codes = np.frombuffer(b"".join(wide), np.uint32).astype(np.int64)
    lengths = np.array([len(w) // 4 for w in wide], np.int64)
    row = np.repeat(np.arange(len(texts)), lengths)
    at = np.flatnonzero(row[1:] == row[:-1])  # where a pair begins
    first, second = codes[at], codes[at + 1]
    plain = (first < TABLE) & (second < TABLE)
    bucket = _table(buckets)[np.where(plain, first * TABLE + second, 0)]
    if not plain.all():
        bucket[~plain] = pair_buckets(first[~plain], second[~plain], buckets)
    alone = np.flatnonzero((lengths == 1)[row])
    cell = np.concatenate([row[at] * buckets + bucket, row[alone] * buckets + single_buckets(codes[alone], buckets)])
    counts = np.bincount(cell, minlength=len(texts) * buckets)
    cells = np.flatnonzero(counts)
    return cells % buckets, counts[cells].astype(float), np.bincount(cells // buckets, minlength=len(texts))


def vectors(texts: pa.Array, buckets: int) -> pa.Array:
    """The counts of each text as sparse vectors in the fields in which Spark stores them; a text that is null has none."""
    plain = [text or b"" for text in texts.cast(pa.binary()).to_pylist()]
    parts = [counted(piece, buckets) for piece in _pieces(plain)] or [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]
    places, values, each = (np.concatenate(p) for p in zip(*parts))
    ends = pa.array(np.concatenate([[0], np.cumsum(each)]), pa.int32())
    return pa.StructArray.from_arrays(
        [pa.array(np.zeros(len(plain)), pa.int8()), pa.array(np.full(len(plain), buckets), pa.int32()),
         pa.ListArray.from_arrays(ends, pa.array(places, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(values, pa.float64()))],
        ["type", "size", "indices", "values"])


class HashedBigrams(Transformer, HasInputCol, HasOutputCol, HasNumFeatures, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the hashed counts of a text's sliding character pairs as a sparse vector."""

    @keyword_only
    def __init__(self, *, inputCol: str = "text", outputCol: str = "features", numFeatures: int = 1000) -> None:
        super().__init__()
        self._setDefault(inputCol="text", outputCol="features", numFeatures=1000)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        buckets = self.getNumFeatures()

        @F.arrow_udf(VectorUDT())
        def features(texts: pa.Array) -> pa.Array:
            return vectors(texts, buckets)

        return dataset.withColumn(self.getOutputCol(), features(F.col(self.getInputCol())))
