"""Scoped caching of a set that is read more than once."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keeps df while the block runs: later reads see the same snapshot of its source."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
