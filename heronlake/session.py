"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Keyed state in RocksDB; a batch uploads its changes, not the whole state.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Folders already written by this driver: (application id, input and its files, name) -> path.
_written: dict[tuple[str, str, str], str] = {}
_local_root: dict[str, str] = {}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "heronlake") -> SparkSession:
    """A session for local runs; on a cluster use the session the cluster gives."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for name, value in STATE_SETTINGS.items():
        builder = builder.config(name, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings every job here relies on: UTC, RocksDB state, small local shuffles."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    master = spark.sparkContext.master
    if master.startswith("local") and spark.conf.get("spark.sql.shuffle.partitions", "200") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a temporary one only for local masters."""
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="heronlake-")
    return _local_root[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def _files_of(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of what a folder holds, with the number and size of the files below: changes when its tables do."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.listStatus(path) if system.exists(path) else []
    def below(f) -> str:
        if not f.isDirectory():
            return ""
        summary = system.getContentSummary(f.getPath())
        return f":{summary.getFileCount()}:{summary.getLength()}"

    return " ".join(sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}{below(f)}" for f in found))


def written_once(spark: SparkSession, source: str, name: str, write) -> str:
    """Path of data written by write(path), once per session and state of the input folder."""
    key = (spark.sparkContext.applicationId, f"{source} {_files_of(spark, source)}", name)
    if key not in _written:
        path = fresh_dir(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all that this application has put in the shared folder. Results that read it are gone as well, so it is for
    the end of a program."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    for key in [k for k in _written if k[0] == spark.sparkContext.applicationId]:
        del _written[key]


def let_go(spark: SparkSession) -> None:
    """Makes Spark delete the shuffle files and cached blocks of results that nothing refers to any more. Spark's cleaner does so
    after a garbage collection on the driver, which a driver with free memory may not see for half an hour."""
    gc.collect()  # handles of the Python side
    spark.sparkContext._jvm.System.gc()


def settle(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts the plan and the lineage.

    For results that are used several times; a lost executor costs no recomputation of them.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, *settled: DataFrame) -> None:
    """Deletes settled results that nothing reads any more, and lets go of the shuffles behind them."""
    for folder in {name.rpartition("/")[0] for df in settled for name in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    let_go(spark)
