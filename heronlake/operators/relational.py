"""Averages, discounts, lookups, profiles: small relational operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mean_by_key(df: DataFrame, key: str, value: str, integer: bool = False) -> DataFrame:
    """Mean per key; integer=True divides the sum by the count and truncates toward zero."""
    mean = F.expr(f"cast(sum(`{value}`) div count(`{value}`) as bigint)") if integer else F.avg(value)
    return df.groupBy(key).agg(mean.alias(f"avg_{value}"))


def discount(df: DataFrame, value: str, rate: float | None = None, pct: float | None = None) -> DataFrame:
    """Adds the discount amount (not the reduced price) by rate (0.1) or by percentage (10)."""
    if (rate is None) == (pct is None):
        raise ValueError("give rate or pct")
    amount = F.col(value) * rate if rate is not None else F.col(value) * pct / 100.0
    return df.withColumn("discount", amount)


def left_default(df: DataFrame, dim: DataFrame, on: str, dim_key: str, dim_value: str,
                 out: str, default: Column) -> DataFrame:
    """Looks `on` up in (dim_key, dim_value); rows without a match get `default`.

    An ordinary left join: Spark broadcasts the map while its measured size is small and
    shuffles it otherwise.
    """
    lookup = dim.select(F.col(dim_key).alias("_key"), F.col(dim_value).alias("_value"))
    return (df.join(lookup, F.col(on) == F.col("_key"), "left")
            .withColumn(out, F.coalesce("_value", default)).drop("_key", "_value"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_distinct): one aggregate per column over that column alone, so rows are not copied once per column and a
    frequent value is one row before it is moved."""
    parts = [df.groupBy(F.col(f"`{c}`").alias("v")).agg(F.lit(1)).agg(F.count("v").alias("n_distinct"))
             .select(F.lit(c).alias("column"), "n_distinct") for c in columns]
    return reduce(DataFrame.unionByName, parts)


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row per column: non-null count, distinct count, least and greatest value."""
    aggs, names = [], []
    for i, field in enumerate(df.schema.fields):
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise ValueError(f"nested column {field.name}")
        c = F.col(f"`{field.name}`")
        names.append(field.name)
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}")]
        aggs += [F.approx_count_distinct(c).alias(f"d{i}")] if approx else []
    rows = [F.struct(F.lit(n).alias("column"), F.col(f"n{i}").alias("non_null"),
                     *([F.col(f"d{i}").alias("n_distinct")] if approx else []),
                     F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value")) for i, n in enumerate(names)]
    profile = df.agg(*aggs).select(F.inline(F.array(*rows)))
    if not approx:
        profile = profile.join(distinct_counts(df, names), "column")
    return profile.select("column", "non_null", "n_distinct", "min_value", "max_value")


def grouped_join_stats(people: DataFrame, projects: DataFrame) -> DataFrame:
    """Average age and greatest id per website over people joined to the projects they manage.

    People are reduced to one row per name before the join, so a frequent name neither
    skews the join nor multiplies rows; the final averages come from sums and counts.
    """
    per_name = people.groupBy("name").agg(
        F.sum("age").alias("_sum"), F.count("age").alias("_cnt"), F.count(F.lit(1)).alias("_rows"))
    return (
        projects.select("website", "manager", "id")
        .join(per_name, F.col("manager") == F.col("name"))
        .groupBy("website")
        .agg((F.sum("_sum") / F.sum("_cnt")).alias("avg_age"), F.max("id").alias("max_id"),
             F.sum("_rows").alias("n"))
    )
