"""Order-dependent operators that stay spread out when one key holds a large share of the rows.

A plain window sends a whole key to one task. Here every key is cut along its order by a `bucket` expression: rows are
stored once, shuffled once by (key, bucket), numbered or summed inside their bucket, and put together again by small
totals per bucket. All keys take this one route, whatever their size. `bucket` must not decrease along the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heronlake.session import settle


def _same(columns: Sequence[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    return same


def _in_buckets(df: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """The rows with their bucket, stored once: the numbering and the totals read the stored rows, never the input again."""
    return settle(df.withColumn("_bucket", bucket), "ordered-rows")


def with_offsets(df: DataFrame, keys: Sequence[str], totals: DataFrame, out: str) -> DataFrame:
    """Adds to each row the sum of `_total` over the earlier buckets of its key; totals has one row per (keys, _bucket)."""
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn(out, F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")
    renamed = offsets.select(*[F.col(k).alias(f"_o_{k}") for k in [*keys, "_bucket"]], out)
    return df.join(renamed, _same([*keys, "_bucket"])).drop(*[f"_o_{k}" for k in [*keys, "_bucket"]])


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, out: str = "pos") -> DataFrame:
    """Adds the 0-based position of each row inside its key."""
    dealt = _in_buckets(df, keys, bucket)
    totals = dealt.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_total"))
    local = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    ranked = with_offsets(dealt.withColumn("_local", local), keys, totals, "_before")
    return (ranked.withColumn(out, (F.col("_before") + F.col("_local") - 1).cast("long"))
            .drop("_bucket", "_local", "_before"))


def sum_below(df: DataFrame, keys: Sequence[str], order: str, value: str, bucket: Column, out: str = "below") -> DataFrame:
    """Adds the sum of `value` over the rows of the key that come strictly earlier in `order`.

    `order` must be unique inside a key (aggregate first).
    """
    dealt = _in_buckets(df, keys, bucket)
    totals = dealt.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_local", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
    return (with_offsets(local, keys, totals, "_before")
            .withColumn(out, (F.col("_before") + F.col("_local")).cast("long")).drop("_bucket", "_local", "_before"))


def moving_avg(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, bucket: Column, lo: int = -1,
               hi: int = 1, out: str = "moving_avg", chunk: int = 1_000_000) -> DataFrame:
    """Average of `value` over rows lo..hi around each row of its key.

    Rows are numbered first, then cut into chunks of `chunk` positions; rows near a chunk border are copied to the
    neighbour so that every frame is complete.
    """
    if lo > 0 or hi < 0:
        raise ValueError("the frame must hold the current row")
    numbered = positions(df, keys, order, bucket, out="_pos")
    own = F.floor(F.col("_pos") / chunk)
    # a row is read by the frames of positions _pos - hi .. _pos - lo
    chunks = F.sequence(F.floor(F.greatest(F.col("_pos") - hi, F.lit(0)) / chunk), F.floor((F.col("_pos") - lo) / chunk))
    copied = numbered.withColumn("_chunk", F.explode(chunks))
    frame = Window.partitionBy(*keys, "_chunk").orderBy("_pos").rowsBetween(lo, hi)
    return (copied.withColumn(out, F.avg(value).over(frame))
            .filter(F.col("_chunk") == own).drop("_chunk", "_pos"))


def concat_by(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], bucket: Column,
              sep: str = "+", chunk: int = 1000) -> DataFrame:
    """The values of a key joined in order: rows (keys, chunk_no, n, joined).

    A string holds at most `chunk` values, so a key of any size never becomes one cell; the
    chunks of a key, taken in order, are the whole text.
    """
    numbered = positions(df.select(*keys, value, *[c for c in order if c != value]),
                         keys, order, bucket)
    return (
        numbered.withColumn("chunk_no", F.expr(f"pos div {int(chunk)}"))
        .groupBy(*keys, "chunk_no")
        .agg(F.count(F.lit(1)).alias("n"),
             F.array_sort(F.collect_list(F.struct("pos", value))).alias("_vals"))
        .select(*keys, "chunk_no", "n",
                F.array_join(F.transform("_vals", lambda s: s[value]), sep).alias("joined"))
    )
