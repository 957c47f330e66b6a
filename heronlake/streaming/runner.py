"""Opening streams, running them over what is available, and reading what they wrote.

Every sink writes batch N to `batch_id=N` in overwrite mode: when a failed batch is run
again, it replaces its own output and nothing else, so results are exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.session import fresh_dir

KINDS = ("files", "socket", "rate", "kafka")


def open_stream(spark: SparkSession, kind: str, schema: str | None = None, file_format: str = "parquet",
                **options: str) -> DataFrame:
    """A streaming DataFrame.

    files: a growing folder (option path); socket: host, port and includeTimestamp;
    kafka: needs the connector package, options kafka.bootstrap.servers and subscribe;
    rate: rowsPerSecond.
    """
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    if kind == "files":
        path = options.pop("path")
        reader = spark.readStream.format(file_format).options(**options)
        return (reader if schema is None else reader.schema(schema)).load(path)
    return spark.readStream.format(kind).options(**options).load()


def batch_writer(path: str, file_format: str = "parquet",
                 change: Callable[[DataFrame, int], DataFrame] | None = None,
                 keys: Sequence[str] = (), merge_every: int = 50) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes change(batch, id) as the whole of `batch_id=id`.

    With keys (update mode) the versions of each key are merged every `merge_every` batches into `path-merged`, so that
    reading needs one merged table and the batches after it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = change(batch, batch_id) if change else batch
        out.write.mode("overwrite").format(file_format).save(f"{path}/batch_id={batch_id}")
        if keys and (batch_id + 1) % merge_every == 0:
            merged = _versions(batch.sparkSession, path, keys, below=batch_id)
            merged.write.mode("overwrite").parquet(f"{path}-merged/batch_id={batch_id}")

    return write


def run_available(df: DataFrame, mode: str, checkpoint: str, write: Callable[[DataFrame, int], None],
                  name: str | None = None) -> None:
    """Runs the stream over all available input, then stops."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    query = writer.foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()


def to_table(df: DataFrame, mode: str, name: str, path: str | None = None, checkpoint: str | None = None,
             change: Callable[[DataFrame, int], DataFrame] | None = None, keys: Sequence[str] = (),
             merge_every: int = 50) -> str:
    """Runs df into a fresh folder of batches and gives its path; keys as in batch_writer."""
    spark = df.sparkSession
    path = path or fresh_dir(spark, name)
    run_available(df, mode, checkpoint or fresh_dir(spark, f"{name}-checkpoint"),
                  batch_writer(path, change=change, keys=keys, merge_every=merge_every))
    return path


def read_batches(spark: SparkSession, path: str, file_format: str = "parquet",
                 schema: str | None = None) -> DataFrame:
    """All batches, with the column batch_id."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(file_format).load(path).withColumn("batch_id", F.col("batch_id").cast("long"))


def read_last(spark: SparkSession, path: str) -> DataFrame:
    """The last batch: the whole result of a complete-mode query."""
    return spark.read.parquet(f"{path}/batch_id={max(batch_ids(spark, path))}")


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches in a folder, from its listing."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.listStatus(folder) if system.exists(folder) else []
    names = [f.getPath().getName() for f in found if f.isDirectory()]
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of each key: the whole result of an update-mode query.

    Update mode writes only the keys a batch changed, which is what large key sets need; max_by merges the versions with a
    partial aggregate. Reads the last merged table, if there is one, and the batches after it.
    """
    return _versions(spark, path, keys).drop("batch_id")


def _versions(spark: SparkSession, path: str, keys: Sequence[str], below: int | None = None) -> DataFrame:
    """Newest version of each key with its batch_id. below: only merged tables of earlier batches are used, so that a replay
    of a batch does not read what its first run merged."""
    merged = [i for i in batch_ids(spark, f"{path}-merged") if below is None or i < below]
    since = merged[-1] if merged else -1
    paths = [f"{path}/batch_id={i}" for i in batch_ids(spark, path) if i > since and (below is None or i <= below)]
    parts = [spark.read.parquet(f"{path}-merged/batch_id={since}")] if merged else []
    if paths:
        recent = spark.read.option("basePath", path).parquet(*paths)
        parts.append(recent.withColumn("batch_id", F.col("batch_id").cast("long")))
    rows = reduce(DataFrame.unionByName, parts)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    return rows.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in values], F.max("batch_id").alias("batch_id"))


def drop_batches(spark: SparkSession, path: str, ids: Sequence[int]) -> None:
    """Deletes the folders of the given batches."""
    jvm = spark.sparkContext._jvm
    for i in ids:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={i}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
