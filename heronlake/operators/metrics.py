"""Evaluation measures as aggregates over rows of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heronlake.operators.ordering import with_offsets
from heronlake.session import settle


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return df.agg(F.avg(F.when(F.col(prediction) == F.col(label), 1.0).otherwise(0.0)).alias("accuracy"))


def confusion(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def auc(df: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label", ties: float = 0.5) -> DataFrame:
    """Share of (positive, negative) pairs ranked right, per `by` group, without building pairs.

    Rows are first reduced to one per score and range-partitioned by group and score, so a group of any size and any spread
    of scores is cut evenly. For each score the negatives strictly below come from a running sum inside the range and
    the totals of the ranges before. Equal scores count `ties` (0.5 is the area under the ROC curve, 0 counts strict
    wins only). Groups without a positive or a negative are left out.
    """
    keys = list(by) or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(0))
    positive = F.when(F.col(label) > 0, 1).otherwise(0)
    counts = rows.groupBy(*keys, F.col(score).alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    # stored, as the borders of the ranges are sampled anew by every evaluation
    counts = settle(counts.repartitionByRange(*keys, "score").withColumn("_bucket", F.spark_partition_id()), "score-counts")
    totals = counts.groupBy(*keys, "_bucket").agg(F.sum("neg").alias("_total"))
    earlier = Window.partitionBy(*keys, "_bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = with_offsets(counts.withColumn("_inside", F.coalesce(F.sum("neg").over(earlier), F.lit(0))), keys, totals, "_before")
    below = F.col("_before") + F.col("_inside")
    wins = F.sum(F.col("pos") * (below + F.col("neg") * ties).cast("double"))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    result = ranked.groupBy(*keys).agg((wins / F.nullif(pairs, F.lit(0.0))).alias("auc")).filter("auc is not null")
    return result if by else result.drop("_all")


def regression_metrics(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """mse, rmse and r2 in one pass."""
    error = F.pow(F.col(prediction) - F.col(label), F.lit(2.0))
    mse = F.avg(error)
    return df.agg(mse.alias("mse"), F.sqrt(mse).alias("rmse"), (1 - mse / F.var_pop(label)).alias("r2"))
