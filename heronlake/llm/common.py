"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Texts are handled in groups of about this many characters, so that numpy temporaries stay small.
GROUP_CHARS = 1 << 20


def crc_fold(doc_id: str, folds: int):
    """crc32 of the id as text modulo folds; a null id counts as the empty text (fold 0)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def groups(texts: list, limit: int = GROUP_CHARS) -> Iterator[slice]:
    """Slices of a list of texts (str or bytes) with about `limit` characters each; a longer text stands alone."""
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text)
        if i > start and held + size > limit:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(texts):
        yield slice(start, len(texts))


def strings(column: pa.Array) -> list[str]:
    """A string column as a list; null becomes the empty text."""
    return [x if x is not None else "" for x in column.to_pylist()]


def scramble(h: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words, so that every bit depends on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
