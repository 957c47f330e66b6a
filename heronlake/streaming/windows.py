"""Event-time windows: tumbling panes, sliding sums of panes, direct sliding counts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heronlake.session import settle

#: Zero rows that one row of a gap stands for.
GAP_PIECE = 4_096

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(duration: str) -> int:
    """'2 hours' -> 7200."""
    found = re.fullmatch(r"(\d+) (second|minute|hour|day)s?", duration.strip())
    if not found:
        raise ValueError(f"not a duration: {duration!r}")
    return int(found.group(1)) * _UNITS[found.group(2)]


def check_slide(length: str, slide: str) -> None:
    if seconds(slide) > seconds(length):
        raise ValueError("the slide must not be longer than the window")


def count_windows(df: DataFrame, keys: Sequence[str], length: str, slide: str | None = None, ts: str = "ts",
                  watermark: str | None = None, aggs: Sequence[Column] | None = None) -> DataFrame:
    """Aggregates per window and key, directly on the rows. Columns: start, end, keys, aggregates."""
    if slide:
        check_slide(length, slide)
    if watermark:
        df = df.withWatermark(ts, watermark)
    span = F.window(ts, length, slide) if slide else F.window(ts, length)
    grouped = df.groupBy(span.alias("window"), *keys).agg(*(aggs or [F.count(F.lit(1)).alias("n")]))
    rest = [c for c in grouped.columns if c != "window"]
    return grouped.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *rest)


def panes(df: DataFrame, keys: Sequence[str], slide: str, ts: str = "ts", watermark: str | None = None,
          aggs: Sequence[Column] | None = None, chain: bool = False) -> DataFrame:
    """Tumbling windows of the slide length: each row is aggregated once, however many windows it is in.

    chain=True adds the time column `at`, which carries the watermark on, for slide_panes
    within the same stream (append mode).
    """
    if not chain:
        return count_windows(df, keys, slide, None, ts, watermark, aggs)
    rows = df.withWatermark(ts, watermark) if watermark else df
    grouped = rows.groupBy(F.window(ts, slide).alias("window"), *keys).agg(*(aggs or [F.count(F.lit(1)).alias("n")]))
    return grouped.withColumn("at", F.window_time("window")).drop("window")


def slide_panes(pane_rows: DataFrame, keys: Sequence[str], length: str, slide: str,
                aggs: Sequence[Column] | None = None) -> DataFrame:
    """Sliding windows from panes; only panes fan out. aggs merge pane columns (default: sum of n)."""
    if seconds(length) % seconds(slide):
        check_slide(length, slide)
        raise ValueError("with panes the window length is a multiple of the slide")
    time = "at" if "at" in pane_rows.columns else "start"
    return count_windows(pane_rows, keys, length, slide, time, aggs=aggs or [F.sum("n").alias("n")])


def keep_zero(counts: DataFrame, keys: Sequence[str], length: str, slide: str) -> DataFrame:
    """Adds a zero row for every later window in which a key seen before has no rows.

    Each key's rows are followed by their gap up to the key's next window (the last one up to
    the last window of all), and only the missing windows are generated.
    """
    counts = settle(counts.select("start", "end", *keys, "n"), "window-counts")
    step, size = seconds(slide), seconds(length)
    following = F.lead("start").over(Window.partitionBy(*keys).orderBy("start"))
    last = counts.agg(F.max("start")).scalar()
    at = F.unix_seconds("start")
    rows = (
        counts.withColumn("_next", following).withColumn("_last", last)
        .withColumn("_missing", F.coalesce(F.expr(f"(unix_seconds(_next) - unix_seconds(start)) div {step} - 1"),
                                           F.expr(f"(unix_seconds(_last) - unix_seconds(start)) div {step}"))))
    # in two steps, so that no array is longer than the root of a gap or GAP_PIECE
    pieces = rows.filter("_missing > 0").select(*keys, "start", "_missing", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(_missing - 1) div {GAP_PIECE}"))).alias("_piece"))
    numbers = pieces.select(*keys, "start", F.explode(F.sequence(
        F.col("_piece") * GAP_PIECE + 1, F.least(F.col("_missing"), (F.col("_piece") + 1) * GAP_PIECE))).alias("_i"))
    zeros = numbers.select(F.timestamp_seconds(at + F.col("_i") * step).alias("start"),
                           F.timestamp_seconds(at + F.col("_i") * step + size).alias("end"), *keys,
                           F.lit(0).cast("long").alias("n"))
    return counts.unionByName(zeros)


def every_window(windows: DataFrame, length: str, slide: str) -> DataFrame:
    """The rows of a report (start, end, columns) with a row of nulls for each window between the first and the last that
    has none. The windows are counted off in parallel, one by one."""
    stored = settle(windows, "windows")
    first, last = stored.agg(F.unix_seconds(F.min("start")), F.unix_seconds(F.max("start"))).first()
    if first is None:
        return stored
    step, size = seconds(slide), seconds(length)
    starts = stored.sparkSession.range(first, last + 1, step).select(
        F.timestamp_seconds("id").alias("start"), F.timestamp_seconds(F.col("id") + size).alias("end"))
    return starts.join(stored.drop("end"), "start", "left")


def as_ntz(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as they are kept in tables."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if f.dataType.simpleString() == "timestamp" else F.col(f.name) for f in df.schema])
