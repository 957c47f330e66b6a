"""Mixing sources to target weights by weighted fair queueing.

Every document is offered up to `max_copies` times. The documents of a source stand in a queue in
shuffled order (md5 of seed and id), copy after copy; the virtual finish time of a place in the
queue is the number of tokens up to its end divided by the weight of the source. All places of all
queues are put in one global order of virtual finish time, range-sorted, and the order is cut where
the running total of tokens would pass the budget. Since a queue ends after `max_copies` rounds,
the cut shares the budget by weight among the sources that still have documents.

Only DataFrame functions are used. A source of any size stays spread out: running sums inside a
source are taken in slices of the md5 order, with small totals per (source, slice); the global order
is cut into ranges of finish time, with one total per range. Only rows per source, per (source, slice)
and per range meet in one window.

Defined cases: null text has size 0; documents of size 0 are returned with taken 0; a null source is
a source of its own, last in order; a null id is shuffled like the empty text; repeated rows are
separate documents (equal rows may swap places, which no result shows); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heronlake.session import settle

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: Fixed value: a word is a run of other characters than these blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: Least common multiple of the weights: virtual times are counted in tokens * UNIT / weight, whole numbers.
UNIT = 10
#: Places of the md5 order that decide the slice of a source (hexadecimal digits).
SLICE_DIGITS = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source: rank, weight, source_size, target, budget. Targets share the sum of all sizes by weight; a target
    stops at max_copies times its source, the rest is shared again by weight (water level). One row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = (totals.withColumn("rank", (F.row_number().over(by_name) - 1).cast("long"))
              .withColumn("weight", weight.cast("long"))
              .withColumn("cap", F.col("source_size") * max_copies))
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("cap") * UNIT / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        ranked.withColumn("budget", F.sum("source_size").over(everything))
        .withColumn("left_tokens", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("left_tokens") / F.col("left_weight"))
        .withColumn("full", F.col("cap") / F.col("weight") <= F.col("level"))
    )
    # sources fill in order of cap / weight: the level of the first one that does not fill holds for all later ones
    final = F.min(F.when(~F.col("full"), F.struct(F.col("cap") * UNIT / F.col("weight"), F.col("rank"), F.col("level"))))
    ranked = ranked.withColumn("water", final.over(everything)["level"])
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("water"))
    return ranked.select("source", "rank", "weight", "source_size", target.alias("target"), "budget")


def queue_places(sizes: DataFrame, targets: DataFrame, max_copies: int, ranges: int) -> DataFrame:
    """Every copy of every document with its virtual finish time, in numbered ranges of it (one stored table)."""
    slices = sizes.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(F.col("source").alias("s_source"), F.col("slice").alias("s_slice"),
                           F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "slice").orderBy("shuffle", "doc_id", "size", "uid")
    queued = (
        sizes.filter("size > 0")
        .withColumn("inside", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .join(slices, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slice") == F.col("s_slice")))
        .select("uid", "source", "size", (F.col("before") + F.col("inside")).alias("upto"))
    )
    t = targets.select(F.col("source").alias("t_source"), "rank", "weight", "source_size")
    places = (
        queued.join(t, F.col("source").eqNullSafe(F.col("t_source")))
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_copies - 1))))
        .select("uid", "size", "rank",
                ((F.col("copy") * F.col("source_size") + F.col("upto")) * (F.lit(UNIT) / F.col("weight")).cast("long"))
                .alias("finish"))
    )
    return (places.repartitionByRange(ranges, "finish", "rank")
            .withColumn("range", F.spark_partition_id()))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES,
        seed: str = "mix") -> DataFrame:
    """Adds size, source_size, target and taken (tokens taken, copies counted) to doc_id and source."""
    if any(UNIT % w for w in weights):
        raise ValueError(f"weights have to divide {UNIT}")
    spark = documents.sparkSession
    shuffle = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sizes = settle(
        documents.select("doc_id", "source", words(F.col("text")).alias("size"))
        .withColumn("shuffle", shuffle).withColumn("slice", F.substring("shuffle", 1, SLICE_DIGITS))
        .withColumn("uid", F.monotonically_increasing_id()), "mix-sizes")
    targets = settle(source_targets(sizes, weights, max_copies), "mix-targets")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = settle(queue_places(sizes, targets, max_copies, ranges), "mix-places")

    totals = places.groupBy("range").agg(F.sum("size").alias("range_size"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("range").alias("r"), F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("range").orderBy("finish", "rank").rowsBetween(Window.unboundedPreceding, 0)
    running = (places.withColumn("inside", F.sum("size").over(order))
               .join(totals, F.col("range") == F.col("r"))
               .withColumn("total", F.col("before") + F.col("inside")))
    budget = targets.agg(F.max("budget").alias("budget"))
    taken = (running.join(F.broadcast(budget), F.col("total") <= F.col("budget"))  # budget: one row
             .groupBy("uid").agg(F.sum("size").alias("taken")))
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    return (
        sizes.join(taken, "uid", "left")
        .join(t, F.col("source").eqNullSafe(F.col("t_source")))
        .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed_documents(documents: DataFrame, **how) -> DataFrame:
    """The documents of the mix: each as many times as it is taken, with the columns it came with."""
    sizes = mix(documents, **how)
    # rows with the same id, source and size share their copies out by number
    copies = (sizes.filter("taken > 0").groupBy("doc_id", "source", "size")
              .agg(F.sort_array(F.collect_list((F.col("taken") / F.col("size")).cast("int")), asc=False).alias("_copies"))
              .select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "_copies"))
    rows = documents.select(F.struct(*documents.columns).alias("_doc"), words(F.col("text")).alias("_words"))
    joined = rows.join(copies, F.col("_doc.doc_id").eqNullSafe(F.col("_id")) & F.col("_doc.source").eqNullSafe(F.col("_source"))
                       & (F.col("_words") == F.col("_size")))
    number = F.row_number().over(Window.partitionBy("_id", "_source", "_size").orderBy("_size"))
    times = joined.withColumn("_times", F.get("_copies", number - 1)).filter("_times > 0")
    return times.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_doc.*")


SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, '')) AS shuffle,
         row_number() OVER (ORDER BY doc_id) AS uid
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank, source_size * 3 AS cap FROM totals),
weighted AS (SELECT *, [5, 2, 1][(rank % 3 + 1)::INT]::BIGINT AS weight FROM ranked),
filled AS (
  SELECT *, (sum(source_size) OVER ())::BIGINT AS budget,
    ((sum(source_size) OVER ())::BIGINT - coalesce((sum(cap) OVER f)::BIGINT, 0))::DOUBLE
      / ((sum(weight) OVER ())::BIGINT - coalesce((sum(weight) OVER f)::BIGINT, 0))::DOUBLE AS level
  FROM weighted
  WINDOW f AS (ORDER BY (cap * 10)::DOUBLE / weight::DOUBLE, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, cap::DOUBLE / weight::DOUBLE <= level AS is_full FROM filled),
water AS (SELECT arg_min(level, (cap * 10)::DOUBLE / weight::DOUBLE) AS water FROM marked WHERE NOT is_full),
targets AS (SELECT m.*, CASE WHEN is_full THEN cap::DOUBLE ELSE weight * water END AS target FROM marked m LEFT JOIN water ON true),
queued AS (
  SELECT s.*, (sum(size) OVER (PARTITION BY source ORDER BY shuffle, doc_id, size, uid
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS upto
  FROM sized s WHERE size > 0),
places AS (
  SELECT q.uid, q.size, t.rank, t.budget, (c.copy * t.source_size + q.upto) * (10 // t.weight) AS finish
  FROM queued q JOIN targets t ON q.source IS NOT DISTINCT FROM t.source CROSS JOIN (SELECT unnest([0, 1, 2]) AS copy) c),
running AS (SELECT uid, size, budget, sum(size) OVER (ORDER BY finish, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM places),
took AS (SELECT uid, sum(size)::BIGINT AS taken FROM running WHERE total <= budget GROUP BY uid)
SELECT s.doc_id, s.size, t.source_size, t.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN took k ON s.uid = k.uid
"""
