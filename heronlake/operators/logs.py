"""Web-server access logs: parsing and reports. All functions run on batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The line format and the names and types of its nine fields.
LINE = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+) (\S+)" (\d{3}) (\d+)'
FIELDS = ["ip_address", "client_identd", "user_id", "date_time", "method", "endpoint", "protocol",
          "response_code", "content_size"]
TYPES = {"response_code": "int", "content_size": "bigint"}

MODES = ("failfast", "dropmalformed", "permissive")


def _record(value: Column) -> Column:
    """One row per line with the fields and `_bad`; for `inline`, so the regex runs once a line.

    The groups are put on lines of their own and cut. They hold no line ends themselves, but a line that does not match
    stays whole and may: it is told by its own text, which the replacement leaves as it was.
    """
    groups = "\n".join(f"${i}" for i in range(1, len(FIELDS) + 1))
    replaced = F.regexp_replace(value, "(?s)" + LINE + ".*", groups)
    parts = F.when(replaced != value, F.split(replaced, "\n")).otherwise(F.array().cast("array<string>"))

    def fields(p: Column) -> Column:
        good = F.size(p) == len(FIELDS)
        cells = {f: F.when(good, F.get(p, F.lit(i))).try_cast(TYPES.get(f, "string")) for i, f in enumerate(FIELDS)}
        bad = cells["response_code"].isNull() | cells["content_size"].isNull()
        return F.struct(*[c.alias(f) for f, c in cells.items()], bad.alias("_bad"))

    return F.transform(F.array(parts), fields)


def parse_access_log(df: DataFrame, mode: str = "dropmalformed", col: str = "value") -> DataFrame:
    """Adds the nine typed fields of each line in place of the line.

    failfast: a bad line fails the query; dropmalformed: it is left out; permissive: its
    fields are null and `_corrupt` holds the line.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    keep = [c for c in df.columns if c != col]
    rows = df.select(*keep, col, F.inline(_record(F.col(col))))
    if mode == "permissive":
        known = [F.when(~F.col("_bad"), F.col(f)).alias(f) for f in FIELDS]
        return rows.select(*keep, *known, F.when(F.col("_bad"), F.col(col)).alias("_corrupt"))
    if mode == "failfast":
        fail = F.when(F.col("_bad"), F.raise_error(F.concat(F.lit("Cannot parse log line: "), F.col(col))))
        return rows.filter(fail.cast("string").isNull()).select(*keep, *FIELDS)
    return rows.filter(~F.col("_bad")).select(*keep, *FIELDS)


def rejects(df: DataFrame, col: str = "value") -> DataFrame:
    """The lines the parser does not accept."""
    return (parse_access_log(df, "permissive", col).filter(F.col("_corrupt").isNotNull())
            .select(*[c for c in df.columns if c != col], F.col("_corrupt").alias(col)))


def content_stats(logs: DataFrame) -> DataFrame:
    """Truncated and exact mean, least and greatest content size in one pass."""
    return logs.agg(
        F.expr("sum(content_size) div count(*)").alias("avg_size"),
        F.round(F.avg("content_size"), 6).alias("mean_size"),
        F.min("content_size").alias("min_size"), F.max("content_size").alias("max_size"))


def stat_counter(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, population deviation, least and greatest value in one pass."""
    return df.agg(
        F.count(col).alias("cnt"), F.round(F.avg(col), 6).alias("mean"),
        F.round(F.stddev_pop(col), 6).alias("stdev"),
        F.max(col).alias("max_value"), F.min(col).alias("min_value"))


def count_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def frequent(df: DataFrame, key: str, threshold: int) -> DataFrame:
    return count_by(df, key).filter(F.col("n") > threshold)


def top_endpoints(logs: DataFrame, k: int = 10) -> DataFrame:
    return count_by(logs, "endpoint").orderBy(F.desc("n"), "endpoint").limit(k)
