"""File sources and sinks."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line; path may be a glob."""
    return spark.read.option("lineSep", "\n").text(path)


def write_lines(df: DataFrame, path: str, mode: str = "error", compression: str = "none") -> None:
    """One text file per partition from a single string column; a gzip file is read by one task."""
    df.write.mode(mode).text(path, compression=compression)


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ",",
                   mode: str = "FAILFAST") -> DataFrame:
    """Delimited records with a declared schema (no inference pass)."""
    return spark.read.csv(path, schema=schema, sep=sep, mode=mode)


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; without a schema Spark infers it from all rows in an extra pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_vectors(spark: SparkSession, path: str, labelled: bool = False) -> DataFrame:
    """Blank-separated numbers per line as a vector; labelled lines are 'label,v1 v2 ...'."""
    lines = read_lines(spark, path)
    text, label = F.col("value"), []
    if labelled:
        label = [F.substring_index("value", ",", 1).cast("double").alias("label")]
        text = F.substring_index("value", ",", -1)
    numbers = F.transform(F.split(F.trim(text), " +"), lambda s: s.cast("double"))
    return lines.select(*label, array_to_vector(numbers).alias("features"))


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """Sparse label/vector lines; give the number of features to save a pass."""
    reader = spark.read.format("libsvm")
    if num_features:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)
