"""Database tables over JDBC. Drivers come with the session, not with this library."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Slices:
    """How to cut a read into parallel range queries on a numeric, date or time column."""

    column: str
    lower: str
    upper: str
    count: int


def read_options(url: str, table: str | None = None, query: str | None = None, driver: str | None = None,
                 slices: Slices | None = None, fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Reader options for a table or for a sub-query used as a table."""
    if (table is None) == (query is None):
        raise ValueError("give table or query")
    options = {"url": url, "dbtable": table if table is not None else f"({query}) x",
               "fetchsize": str(fetch_size), **extra}
    if driver:
        options["driver"] = driver
    if slices:
        options.update(partitionColumn=slices.column, lowerBound=slices.lower,
                       upperBound=slices.upper, numPartitions=str(slices.count))
    return options


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """A database table or sub-query; filters on the result are pushed to the database."""
    return spark.read.format("jdbc").options(**read_options(url, **kwargs)).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               connections: int | None = None, batch_size: int = 10_000, **extra: str) -> None:
    """append adds rows; overwrite makes the table anew with the columns of df.

    `connections` bounds the tasks that write at the same time.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError("mode is append or overwrite")
    writer = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    writer = writer.option("batchsize", str(batch_size)).options(**extra)
    if connections:
        writer = writer.option("numPartitions", str(connections))
    writer.save()
