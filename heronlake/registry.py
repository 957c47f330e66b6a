"""Registered jobs: key -> (build function, SQL that gives the same rows)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from heronlake.session import prepare

JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def job(key: str, sql: str | None = None):
    def register(build):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir.rstrip("/"))

        if key in JOBS:
            raise ValueError(f"duplicate job {key}")
        JOBS[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return run

    return register


def load_all() -> None:
    """Import every module that registers jobs."""
    from heronlake import plans  # noqa: F401
