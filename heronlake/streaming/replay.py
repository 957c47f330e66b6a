"""A table as a stream: time-ordered slices written as files, one slice per micro-batch."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.session import written_once
from heronlake.streaming.runner import open_stream

SLICES = 3
ROWS_PER_FILE = 5_000_000
FEW_ROWS = 500


def write_slices(df: DataFrame, order: str, path: str, slices: int = SLICES, files: int | None = None,
                 file_format: str = "parquet", only: range | None = None) -> int:
    """Cuts df into equal ranges of the integer `order` column, written one after the other
    (or just the slices numbered in `only`).

    Every slice has the same number of files, so that maxFilesPerTrigger makes it one batch:
    enough to keep the cores busy, and none with more than ROWS_PER_FILE rows.
    """
    lo, hi, rows = df.agg(F.min(order), F.max(order), F.count(F.lit(1))).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    files = files or max(1, ceil(rows / slices / ROWS_PER_FILE), min(cores, ceil(rows / slices / FEW_ROWS)))
    width = ceil((hi - lo + 1) / slices)
    for i in only or range(slices):
        part = df.filter((F.col(order) >= lo + i * width) & (F.col(order) < lo + (i + 1) * width))
        part.repartition(files).write.mode("append").format(file_format).save(path)
    return files


_files: dict[str, int] = {}


def replay(spark: SparkSession, sf_dir: str, name: str, df: DataFrame, order: str,
           slices: int = SLICES, file_format: str = "parquet") -> DataFrame:
    """df as a stream of `slices` micro-batches in the order of an integer column."""

    def write(path: str) -> None:
        _files[path] = write_slices(df, order, path, slices, file_format=file_format)

    path = written_once(spark, sf_dir, f"{name}-{slices}-{file_format}", write)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return open_stream(spark, "files", schema, file_format, path=path,
                       maxFilesPerTrigger=str(_files[path]))
