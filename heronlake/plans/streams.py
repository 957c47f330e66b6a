"""Streaming jobs: a replayed table goes through a stream; the result is what its sink holds."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from heronlake.operators import logs as logops
from heronlake.operators import text as textops
from heronlake.plans import oracle as o
from heronlake.plans.text import line_files
from heronlake.registry import job
from heronlake.session import fresh_dir, written_once
from heronlake.sources.tables import (access_log, blacklist, lexicon, messages, status, table)

from heronlake.streaming.replay import replay, write_slices
from heronlake.streaming.runner import (batch_writer, open_stream, read_batches, read_last, read_latest,
                                        run_available, to_table)
from heronlake.streaming.state import (COUNT, Fold, collect_until, count_per_record, fold_by_key, keep_recent,
                                       sliding_counts, top_finished)
from heronlake.streaming.windows import (as_ntz, count_windows, every_window, keep_zero, panes, seconds, slide_panes)

IP_THRESHOLD = 20
LATE = "1 day"


# --- streams and their SQL ------------------------------------------------------

def log_stream(spark, sf_dir):
    lines = replay(spark, sf_dir, "log", access_log(spark, sf_dir), "event_id")
    return logops.parse_access_log(lines)


def message_stream(spark, sf_dir):
    return replay(spark, sf_dir, "messages", messages(spark, sf_dir), "event_id")


def message_words(spark, sf_dir):
    return textops.tokenize(message_stream(spark, sf_dir))


def doc_words(spark, sf_dir):
    docs = replay(spark, sf_dir, "documents", table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return textops.tokenize(docs.select("doc_id", F.explode(F.split("text", "\n")).alias("value")))


def status_stream(spark, sf_dir):
    return replay(spark, sf_dir, "status", status(spark, sf_dir), "id")


def tag_stream(spark, sf_dir):
    rows = status_stream(spark, sf_dir).select("id", F.col("createdAt").alias("ts"), "text")
    return textops.tag_rows(rows)


def slice_of(table_name: str, col: str, slices: int = 3) -> str:
    return (f"(({col} - (SELECT min({col}) FROM {table_name})) // (SELECT CAST(ceil((max({col}) - min({col}) + 1) "
            f"/ {slices}.0) AS BIGINT) FROM {table_name}))")


def windowed(source: str, length: str, slide: str | None = None) -> str:
    """SQL for source rows once per window they lie in, with its start and end."""
    size, step = seconds(length), seconds(slide or length)
    pane = f"CAST(floor(epoch(ts) / {step}) AS BIGINT) * {step}"
    return (f"(SELECT *, make_timestamp((pane - j * {step}) * 1000000) AS start, "
            f"make_timestamp((pane - j * {step} + {size}) * 1000000) AS \"end\" FROM "
            f"(SELECT *, {pane} AS pane, unnest(range(0, {size // step})) AS j FROM {source}))")


# --- running counts ----------------------------------------------------------------

@job("stream_word_count", f"WITH {o.WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def stream_word_count(spark, sf_dir):
    """The whole vocabulary with its counts, read from the versions of changed words that the batches have left."""
    counts = textops.word_count(doc_words(spark, sf_dir))
    return read_latest(spark, to_table(counts, "update", "word-count", keys=["word"]), ["word"])


@job("stream_running_counts", f"WITH {o.WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def stream_running_counts(spark, sf_dir):
    """All keys with their running counts; a batch writes only the keys it changed."""
    counts = textops.word_count(doc_words(spark, sf_dir))
    return read_latest(spark, to_table(counts, "update", "running", keys=["word"]), ["word"])


STATS = """CAST(sum(content_size) // count(*) AS BIGINT) AS avg_size, min(content_size) AS min_size,
    max(content_size) AS max_size, count(*) AS n"""


@job("stream_running_stats", f"""{o.LOGS} SELECT count(*) AS n, CAST(sum(content_size) AS BIGINT) AS total,
    min(content_size) AS min_size, max(content_size) AS max_size FROM logs""")
def stream_running_stats(spark, sf_dir):
    totals = log_stream(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"), F.sum("content_size").alias("total"),
        F.min("content_size").alias("min_size"), F.max("content_size").alias("max_size"))
    return read_last(spark, to_table(totals, "complete", "stats"))


@job("stream_total_codes", f"{o.LOGS} SELECT response_code, count(*) AS n FROM logs GROUP BY response_code")
def stream_total_codes(spark, sf_dir):
    totals = logops.count_by(log_stream(spark, sf_dir), "response_code")
    return read_last(spark, to_table(totals, "complete", "codes"))


@job("stream_total_ips", f"{o.LOGS} SELECT ip_address, count(*) AS n FROM logs GROUP BY ip_address HAVING count(*) > 66")
def stream_total_ips(spark, sf_dir):
    totals = logops.count_by(log_stream(spark, sf_dir), "ip_address")
    path = to_table(totals, "update", "ips")
    return read_latest(spark, path, ["ip_address"]).filter("n > 66")


@job("stream_total_endpoints",
     f"{o.LOGS} SELECT endpoint, count(*) AS n FROM logs GROUP BY endpoint ORDER BY n DESC, endpoint LIMIT 10")
def stream_total_endpoints(spark, sf_dir):
    top = logops.top_endpoints(log_stream(spark, sf_dir), 10)
    return read_last(spark, to_table(top, "complete", "endpoints"))


# --- one result per micro-batch -----------------------------------------------------

BATCH = slice_of("events", "event_id")
BATCH_WORDS = f"WITH {o.MESSAGE_WORDS}, counts AS (SELECT {BATCH} AS batch_id, word, count(*) AS n FROM words GROUP BY ALL)"


@job("stream_batch_top_words", f"""WITH {o.MESSAGE_WORDS},
    rows AS (SELECT {BATCH} AS batch_id, part, word, ts FROM words),
    counts AS (SELECT batch_id, part, word, count(*) AS n, max(ts) AS last FROM rows GROUP BY ALL)
    SELECT batch_id, max(last) OVER (PARTITION BY batch_id) AS batch_time, part, word, n FROM counts
    QUALIFY row_number() OVER (PARTITION BY batch_id, part ORDER BY n DESC, word) <= 5""")
def stream_batch_top_words(spark, sf_dir):
    """The five most frequent words of each batch and message partition, with the batch's (event) time."""
    def top(batch, _):
        counts = batch.groupBy("part", "word").agg(F.count(F.lit(1)).alias("n"))
        place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("n"), "word"))
        time = batch.agg(F.max("ts")).scalar()  # one row, read after the cut
        return counts.withColumn("place", place).filter("place <= 5").select("part", "word", "n", time.alias("batch_time"))

    return as_ntz(read_batches(spark, to_table(message_words(spark, sf_dir), "append", "batch-top", change=top)))


@job("stream_sql_word_count", f"{BATCH_WORDS} SELECT batch_id, word, n FROM counts")
def stream_sql_word_count(spark, sf_dir):
    def report(batch, _):
        batch.createOrReplaceTempView("batch_words")
        return batch.sparkSession.sql("SELECT word, count(*) AS n FROM batch_words GROUP BY word")

    return read_batches(spark, to_table(message_words(spark, sf_dir), "append", "batch-sql", change=report))


@job("stream_batch_tag",
     f"{BATCH_WORDS} SELECT concat('batch-', CAST(batch_id AS VARCHAR)) AS tag, word, n FROM counts")
def stream_batch_tag(spark, sf_dir):
    path = to_table(message_words(spark, sf_dir), "append", "batch-tag",
                    change=lambda batch, i: textops.word_count(batch).withColumn("tag", F.lit(f"batch-{i}")))
    return read_batches(spark, path).select("tag", "word", "n")


@job("stream_offset_ranges", f"""WITH {o.MESSAGES} SELECT {BATCH} AS batch_id, topic, part,
    min(offs) AS from_offset, max(offs) + 1 AS until_offset FROM messages GROUP BY ALL""")
def stream_offset_ranges(spark, sf_dir):
    def ranges(batch, _):
        return batch.groupBy("topic", "part").agg(
            F.min("offs").alias("from_offset"), (F.max("offs") + 1).alias("until_offset"))

    return read_batches(spark, to_table(message_stream(spark, sf_dir), "append", "offsets", change=ranges))


@job("stream_kafka_like_counts", f"WITH {o.MESSAGE_WORDS} SELECT topic, word, count(*) AS n FROM words GROUP BY topic, word")
def stream_kafka_like_counts(spark, sf_dir):
    """Broker-shaped rows; with the connector package the same job reads open_stream('kafka', ...)."""
    counts = textops.word_count(message_words(spark, sf_dir), by=["topic"])
    return read_latest(spark, to_table(counts, "update", "broker", keys=["topic", "word"]), ["topic", "word"])


# --- cleaning with a blacklist --------------------------------------------------------

DOC_BATCH = slice_of("documents", "doc_id")


def blacklist_table(spark, sf_dir) -> str:
    """Counts per batch with a flag for dropped words: both reports read the table of one pass."""
    listed = blacklist(spark).withColumn("dropped", F.lit(True))

    def flag(batch, _):
        return (textops.word_count(batch).join(listed, "word", "left")
                .withColumn("dropped", F.coalesce("dropped", F.lit(False))))

    return written_once(spark, sf_dir, "blacklist", lambda path: to_table(
        doc_words(spark, sf_dir), "append", "blacklist", path=path, change=flag))


@job("stream_blacklist_counts", f"""WITH {o.WORDS}, {o.BLACKLIST} SELECT {DOC_BATCH} AS batch_id, word, count(*) AS n
    FROM words WHERE word NOT IN (SELECT word FROM blacklist) GROUP BY ALL""")
def stream_blacklist_counts(spark, sf_dir):
    return read_batches(spark, blacklist_table(spark, sf_dir)).filter("not dropped").drop("dropped")


@job("stream_dropped_words", f"""WITH {o.WORDS}, {o.BLACKLIST}, per_batch AS (SELECT {DOC_BATCH} AS batch_id,
      count(*) AS dropped FROM words WHERE word IN (SELECT word FROM blacklist) GROUP BY ALL)
    SELECT batch_id, dropped, CAST(sum(dropped) OVER (ORDER BY batch_id) AS BIGINT) AS total FROM per_batch""")
def stream_dropped_words(spark, sf_dir):
    """Dropped words of each batch and of all batches up to it; the table outlives a restart, and so does the total."""
    rows = read_batches(spark, blacklist_table(spark, sf_dir)).filter("dropped")
    per_batch = rows.groupBy("batch_id").agg(F.sum("n").alias("dropped"))  # a row per batch
    return per_batch.withColumn("total", F.sum("dropped").over(Window.orderBy("batch_id")))


# --- event-time windows -------------------------------------------------------------------

def ended(spark, sf_dir, name, rows, order, length, beat=None):
    """rows (with ts) as a stream whose last batch brings a row without content that moves the watermark past the end of all
    windows of the length; carries the watermark. beat: how far past the last row the watermark goes, if not by the length."""
    last = rows.agg((F.max(order) + 1).alias(order), F.max("ts").alias("ts"))
    beyond = F.expr(f"INTERVAL {beat or length}") + F.expr(f"INTERVAL {LATE}")
    mark = last.select(order, (F.col("ts") + beyond).alias("ts"),
                       *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name not in (order, "ts")])
    return replay(spark, sf_dir, f"{name}-ended", rows.unionByName(mark.filter("ts is not null")), order).withWatermark("ts", LATE)


WINDOWED_WORDS = f"""WITH {o.MESSAGE_WORDS}, counts AS (SELECT start, "end", word, count(*) AS n
    FROM {windowed("words", "2 days", "1 day")} GROUP BY ALL)"""


def finished_words(spark, sf_dir):
    """Counts per window and word in append mode: a window is written once, when it is over, and leaves the state."""
    rows = ended(spark, sf_dir, "messages", messages(spark, sf_dir), "event_id", "3 days")
    return count_windows(textops.tokenize(rows), ["word"], "2 days", "1 day")


@job("stream_windowed_words", f'{WINDOWED_WORDS} SELECT start, "end", word, n FROM counts')
def stream_windowed_words(spark, sf_dir):
    path = to_table(finished_words(spark, sf_dir), "append", "windowed")
    return as_ntz(read_batches(spark, path).drop("batch_id").orderBy(F.desc("start"), "word"))


@job("stream_windowed_top", f"""{WINDOWED_WORDS} SELECT start, "end", word, n,
    CAST(row_number() OVER (PARTITION BY start ORDER BY n DESC, word) AS INTEGER) AS place FROM counts QUALIFY place <= 5""")
def stream_windowed_top(spark, sf_dir):
    """The five most frequent words of every finished window, by a second stateful step in the same query."""
    path = to_table(top_finished(finished_words(spark, sf_dir), "word", 5), "append", "windowed-top")
    return as_ntz(read_batches(spark, path).drop("batch_id"))


LENGTH, SLIDE = "2 days", "12 hours"
WINDOW_LOGS = windowed("logs", LENGTH, SLIDE)


def log_panes(spark, sf_dir, keys, name, aggs=None):
    rows = panes(log_stream(spark, sf_dir), keys, SLIDE, watermark=LATE, aggs=aggs)
    return read_latest(spark, to_table(rows, "update", name, keys=["start", "end", *keys]), ["start", "end", *keys])


@job("stream_log_stats", f"""{o.LOGS}, report AS (SELECT start, {STATS} FROM {WINDOW_LOGS} GROUP BY start),
    starts AS (SELECT unnest(generate_series((SELECT min(start) FROM report), (SELECT max(start) FROM report),
      INTERVAL 12 HOUR)) AS start)
    SELECT start, start + INTERVAL 2 DAY AS "end", avg_size, min_size, max_size, coalesce(n, 0) AS n
    FROM starts LEFT JOIN report USING (start)""")
def stream_log_stats(spark, sf_dir):
    parts = log_panes(spark, sf_dir, [], "log-stats", [
        F.count(F.lit(1)).alias("n"), F.sum("content_size").alias("total"),
        F.min("content_size").alias("min_size"), F.max("content_size").alias("max_size")])
    report = slide_panes(parts, [], LENGTH, SLIDE, [
        F.expr("sum(total) div sum(n)").alias("avg_size"), F.min("min_size").alias("min_size"),
        F.max("max_size").alias("max_size"), F.sum("n").alias("n")])
    # a window without a line has its row too
    return as_ntz(every_window(report, LENGTH, SLIDE).withColumn("n", F.coalesce("n", F.lit(0).cast("long"))))


@job("stream_log_codes",
     f'{o.LOGS} SELECT start, "end", response_code, count(*) AS n FROM {WINDOW_LOGS} GROUP BY ALL')
def stream_log_codes(spark, sf_dir):
    return as_ntz(slide_panes(log_panes(spark, sf_dir, ["response_code"], "log-codes"),
                              ["response_code"], LENGTH, SLIDE))


@job("stream_log_ips", f"""{o.LOGS} SELECT start, "end", ip_address, count(*) AS n FROM {WINDOW_LOGS}
    GROUP BY ALL HAVING count(*) > {IP_THRESHOLD // 2}""")
def stream_log_ips(spark, sf_dir):
    counts = slide_panes(log_panes(spark, sf_dir, ["ip_address"], "log-ips"), ["ip_address"], LENGTH, SLIDE)
    return as_ntz(counts.filter(F.col("n") > IP_THRESHOLD // 2))


def top_per_window(counts, key, k, n="n"):
    """Spark cuts each map task to k rows per window before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("start").orderBy(F.desc(n), key))
    return counts.withColumn("place", rank).filter(F.col("place") <= k)


@job("stream_log_endpoints", f"""{o.LOGS} SELECT start, "end", endpoint, count(*) AS n,
    CAST(row_number() OVER (PARTITION BY start ORDER BY count(*) DESC, endpoint) AS INTEGER) AS place
    FROM {WINDOW_LOGS} GROUP BY start, "end", endpoint QUALIFY place <= 10""")
def stream_log_endpoints(spark, sf_dir):
    counts = slide_panes(log_panes(spark, sf_dir, ["endpoint"], "log-ends"), ["endpoint"], LENGTH, SLIDE)
    return as_ntz(top_per_window(counts, "endpoint", 10))


@job("stream_log_sql", f"""{o.LOGS} SELECT start, response_code, CAST(sum(content_size) AS BIGINT) AS total,
    count(*) AS n, min(content_size) AS min_size, max(content_size) AS max_size
    FROM {WINDOW_LOGS} GROUP BY start, response_code""")
def stream_log_sql(spark, sf_dir):
    """SQL on the stream gives panes; SQL on the stored panes slides over them."""
    log_stream(spark, sf_dir).withWatermark("ts", LATE).createOrReplaceTempView("log_stream")
    pane = spark.sql(f"""
        SELECT window.start AS start, response_code, sum(content_size) AS total, count(*) AS n,
               min(content_size) AS min_size, max(content_size) AS max_size
        FROM log_stream GROUP BY window(ts, '{SLIDE}'), response_code""")
    keys = ["start", "response_code"]
    read_latest(spark, to_table(pane, "update", "log-sql", keys=keys), keys).createOrReplaceTempView("log_panes")
    return as_ntz(spark.sql(f"""
        SELECT window.start AS start, response_code, sum(total) AS total, sum(n) AS n, min(min_size) AS min_size,
               max(max_size) AS max_size
        FROM (SELECT start AS ts, * EXCEPT (start) FROM log_panes) GROUP BY window(ts, '{LENGTH}', '{SLIDE}'), response_code"""))


@job("stream_sliding_counts", f"""WITH {o.TAGS} SELECT start, "end", tag, count(*) AS n
    FROM {windowed("tags", "2 days", "1 day")} GROUP BY ALL""")
def stream_sliding_counts(spark, sf_dir):
    counts = count_windows(tag_stream(spark, sf_dir), ["tag"], "2 days", "1 day", watermark=LATE)
    return as_ntz(read_latest(spark, to_table(counts, "update", "sliding", keys=["start", "end", "tag"]), ["start", "end", "tag"]))


PANE_LENGTH, PANE_SLIDE = "10 days", "6 hours"


@job("stream_sliding_counts_panes", f"""WITH {o.TAGS} SELECT start, "end", tag, count(*) AS n
    FROM {windowed("tags", PANE_LENGTH, PANE_SLIDE)} GROUP BY ALL""")
def stream_sliding_counts_panes(spark, sf_dir):
    rows = panes(tag_stream(spark, sf_dir), ["tag"], PANE_SLIDE, watermark=LATE)
    parts = read_latest(spark, to_table(rows, "update", "panes", keys=["start", "end", "tag"]), ["start", "end", "tag"])
    return as_ntz(slide_panes(parts, ["tag"], PANE_LENGTH, PANE_SLIDE))


KEEP_ZERO = f"""WITH {o.LOGS.removeprefix('WITH ')}, counts AS (
      SELECT start, ip_address, count(*) AS n FROM {windowed("logs", "12 hours", "6 hours")} GROUP BY ALL),
    grid AS (SELECT s.start, k.ip_address FROM (SELECT DISTINCT start FROM
        (SELECT unnest(generate_series((SELECT min(start) FROM counts), (SELECT max(start) FROM counts),
           INTERVAL 6 HOUR)) AS start)) s
      JOIN (SELECT ip_address, min(start) AS since FROM counts GROUP BY ip_address) k ON s.start >= k.since)
    SELECT g.start, g.start + INTERVAL 12 HOUR AS "end", g.ip_address, coalesce(c.n, 0) AS n
    FROM grid g LEFT JOIN counts c USING (start, ip_address)"""


@job("sliding_counts_keep_zero", KEEP_ZERO)
def sliding_counts_keep_zero(spark, sf_dir):
    """A key stays in the report with a zero after its rows have left the window."""
    rows = logops.parse_access_log(access_log(spark, sf_dir))
    counts = slide_panes(panes(rows, ["ip_address"], "6 hours"), ["ip_address"], "12 hours", "6 hours")
    return as_ntz(keep_zero(counts, ["ip_address"], "12 hours", "6 hours"))


@job("stream_sliding_counts_inverse", KEEP_ZERO)
def stream_sliding_counts_inverse(spark, sf_dir):
    """The same report from a stream: each pane is added once and taken off once, zeros come from timers."""
    lines = access_log(spark, sf_dir)
    # the watermark ends between the end of the last pane's last window and that of the next window
    stream = ended(spark, sf_dir, "log", lines, "event_id", "12 hours")
    counts = sliding_counts(logops.parse_access_log(stream), "ip_address", "12 hours", "6 hours")
    path = to_table(counts, "append", "sliding-inverse")
    return as_ntz(read_batches(spark, path).drop("batch_id"))


def popular_sql(length: str) -> str:
    return f"""WITH {o.TAGS}, counts AS (SELECT start, tag AS hashtag, count(*) AS n
          FROM {windowed("tags", length, SLIDE)} GROUP BY start, tag)
        SELECT start, hashtag, n, CAST(row_number() OVER (PARTITION BY start ORDER BY n DESC, hashtag) AS INTEGER)
          AS place, count(*) OVER (PARTITION BY start) AS tags FROM counts QUALIFY place <= 10"""


def popular_tags(spark, sf_dir, length):
    """Top ten tags per window and the number of tags in it."""
    rows = panes(tag_stream(spark, sf_dir), ["tag"], SLIDE, watermark=LATE)
    parts = read_latest(spark, to_table(rows, "update", "popular", keys=["start", "end", "tag"]), ["start", "end", "tag"])
    counts = slide_panes(parts, ["tag"], length, SLIDE)
    sizes = counts.groupBy("start").agg(F.count(F.lit(1)).alias("tags"))
    top = top_per_window(counts, "tag", 10).join(sizes, "start")
    return as_ntz(top.select("start", F.col("tag").alias("hashtag"), "n", "place", "tags"))


@job("stream_popular_tags_long", popular_sql("6 days"))
def stream_popular_tags_long(spark, sf_dir):
    return popular_tags(spark, sf_dir, "6 days")


@job("stream_popular_tags_short", popular_sql("1 day"))
def stream_popular_tags_short(spark, sf_dir):
    return popular_tags(spark, sf_dir, "1 day")


@job("stream_recent_rows", f"""WITH {o.STATUS} SELECT CAST(floor(epoch(created_at)) AS BIGINT) AS created_at, text
    FROM status WHERE created_at > (SELECT max(created_at) FROM status) - INTERVAL 2 DAY AND text LIKE '%#purchase%'""")
def stream_recent_rows(spark, sf_dir):
    """Rows of the last two days of the stream, kept as a table that lets older batches go, and queried with LIKE."""
    path = fresh_dir(spark, "recent")
    keep_recent(status_stream(spark, sf_dir), "createdAt", "2 days", path, fresh_dir(spark, "recent-checkpoint"))
    read_batches(spark, path).createOrReplaceTempView("stored_status")
    return spark.sql("""SELECT unix_seconds(createdAt) AS created_at, text FROM stored_status
        WHERE createdAt > (SELECT max(createdAt) FROM stored_status) - INTERVAL 2 DAYS
          AND text LIKE '%#purchase%'""")


LATE_ROWS = """arrivals AS (SELECT event_id, ts, event_type, event_id % 50 = 0 AS late,
      event_id * 2 < (SELECT max(event_id) + 1 FROM events) AS first_half FROM events),
    marks AS (SELECT max(ts) FILTER (first_half) - INTERVAL 1 DAY AS early, max(ts) - INTERVAL 1 DAY AS final
      FROM arrivals WHERE NOT late)"""


@job("stream_late_dropped", f"""WITH {LATE_ROWS} SELECT start, event_type, count(*) AS n
    FROM {windowed("arrivals", "12 hours")} WHERE NOT late
      OR "end" > (SELECT CASE WHEN first_half THEN early ELSE final END FROM marks)
    GROUP BY start, event_type""")
def stream_late_dropped(spark, sf_dir):
    """Every 50th row arrives after all others; those whose window is already closed are left out."""
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    size = rows.agg(F.max("event_id")).scalar() + 1
    arrivals = rows.withColumn(
        "arrival", F.when(F.col("event_id") % 50 == 0, F.col("event_id") + size).otherwise(F.col("event_id")))
    # four slices: on time first and second half, then the late rows of each half; two empty
    # rows at the ends of the range fix its borders
    ends = rows.agg(F.max("event_id").alias("event_id")).select(
        "event_id", F.lit(None).cast("timestamp").alias("ts"), F.lit(None).cast("string").alias("event_type"),
        F.explode(F.array(F.lit(0).cast("long"), F.col("event_id") * 2 + 1)).alias("arrival"))
    edges = arrivals.unionByName(ends)
    stream = replay(spark, sf_dir, "late", edges, "arrival", slices=4).filter("ts is not null")
    counts = count_windows(stream, ["event_type"], "12 hours", watermark=LATE).drop("end")
    return as_ntz(read_latest(spark, to_table(counts, "update", "late", keys=["start", "event_type"]), ["start", "event_type"]))


# --- state ------------------------------------------------------------------------------

@job("stream_map_with_state", """SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type
      ORDER BY ts, event_id) + CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS n FROM events""")
def stream_map_with_state(spark, sf_dir):
    """The running count of the event type at every event; two types start at one."""
    rows = message_stream(spark, sf_dir).select(
        "event_id", "ts", F.substring_index("value", " ", 1).alias("event_type"))
    start = spark.createDataFrame([("click", 1), ("view", 1)], "event_type string, n long")
    path = fresh_dir(spark, "per-record")
    count_per_record(rows, "event_type", ["ts", "event_id"], F.date_trunc("second", "ts"), path,
                     fresh_dir(spark, "per-record-checkpoint"), initial=start)
    return read_batches(spark, path).select("event_id", "event_type", "n")


@job("stream_update_state", f"""WITH {o.MESSAGE_WORDS} SELECT word, count(*) +
      CASE WHEN word IN ('click', 'view') THEN 1 ELSE 0 END AS n FROM words GROUP BY word""")
def stream_update_state(spark, sf_dir):
    """A user's fold as keyed state with an initial value."""
    start = spark.createDataFrame([("click", 1), ("view", 1)], "word string, n long")
    totals = fold_by_key(message_words(spark, sf_dir), "word", COUNT, initial=start)
    return read_latest(spark, to_table(totals, "update", "fold", keys=["word"]), ["word"])


#: Least and greatest event of a word so far: a fold that is no sum but can be merged.
EXTREMES = Fold("least long, greatest long", lambda: (None, None),
                lambda state, rows: least_greatest(state, (int(rows["event_id"].min()), int(rows["event_id"].max()))),
                lambda a, b: least_greatest(a, b))


def least_greatest(a, b):
    if a[0] is None or b[0] is None:
        return b if a[0] is None else a
    return min(a[0], b[0]), max(a[1], b[1])


@job("stream_state_extremes", f"WITH {o.MESSAGE_WORDS} SELECT word, min(event_id) AS least, max(event_id) AS greatest FROM words GROUP BY word")
def stream_state_extremes(spark, sf_dir):
    totals = fold_by_key(message_words(spark, sf_dir), "word", EXTREMES, columns=["event_id"])
    return read_latest(spark, to_table(totals, "update", "extremes", keys=["word"]), ["word"])


def last_two(state, rows):
    """The last two values and how often the value changed: depends on the order of the rows and cannot be merged."""
    before, last, changes = state
    for value in rows["event_type"]:
        changes += int(last is not None and value != last)
        before, last = last, value
    return before, last, changes


LAST_TWO = Fold("before string, last string, changes long", lambda: (None, None, 0), last_two)


@job("stream_state_last", """WITH steps AS (SELECT user_id, event_type, ts, event_id,
      lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
    SELECT user_id, arg_max(prev, (ts, event_id)) AS before, arg_max(event_type, (ts, event_id)) AS last,
      count(*) FILTER (WHERE prev <> event_type) AS changes FROM steps GROUP BY user_id""")
def stream_state_last(spark, sf_dir):
    """An ordered fold per user: rows of a batch reach it in order of time."""
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    stream = replay(spark, sf_dir, "events", rows, "event_id")
    totals = fold_by_key(stream, "user_id", LAST_TWO, columns=["event_type", "ts", "event_id"], order=["ts", "event_id"])
    return read_latest(spark, to_table(totals, "update", "last-two", keys=["user_id"]), ["user_id"])


@job("stream_recovered_counts", f"WITH {o.MESSAGE_WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def stream_recovered_counts(spark, sf_dir):
    """Stopped after two slices and started again from the checkpoint when the third is there."""
    source, path, checkpoint = (fresh_dir(spark, f"recover-{x}") for x in ("in", "out", "checkpoint"))
    rows = messages(spark, sf_dir)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    for part in (range(0, 2), range(2, 3)):
        write_slices(rows, "event_id", source, only=part)
        stream = open_stream(spark, "files", schema, path=source)
        to_table(textops.word_count(textops.tokenize(stream)), "update", "recover", path, checkpoint)
    return read_latest(spark, path, ["word"])


# --- sinks and sources ---------------------------------------------------------------------

@job("stream_idempotent_sink", f"WITH {o.MESSAGES} SELECT {BATCH} AS batch_id, part, value FROM messages")
def stream_idempotent_sink(spark, sf_dir):
    """All batches are delivered twice, as after a failure; the table holds them once."""
    rows = message_stream(spark, sf_dir).select("part", "value")
    path = to_table(rows, "append", "idempotent")
    to_table(rows, "append", "idempotent", path)
    return read_batches(spark, path)


@job("stream_collect_json", f"""WITH {o.STATUS} SELECT {slice_of("status", "id")} AS batch_id, id, lang, name, text FROM status""")
def stream_collect_json(spark, sf_dir):
    """Each non-empty batch as JSON lines in its own folder, in four files."""
    path = fresh_dir(spark, "json")
    store = batch_writer(path, "json", change=lambda batch, _: batch.drop("createdAt").repartition(4))

    def write(batch, batch_id):
        batch.persist()  # looked at and written: read once
        if not batch.isEmpty():
            store(batch, batch_id)
        batch.unpersist()

    run_available(status_stream(spark, sf_dir), "append", fresh_dir(spark, "json-checkpoint"), write)
    rows = read_batches(spark, path, "json", "id bigint, user struct<lang:string,name:string>, text string, batch_id bigint")
    return rows.select("batch_id", "id", "user.lang", "user.name", "text")


COLLECT_TARGETS = (500, 900)


@job("stream_collect_until", f"""WITH sized AS (SELECT {BATCH} AS batch_id, count(*) AS n FROM events GROUP BY ALL),
    running AS (SELECT batch_id, n, sum(n) OVER (ORDER BY batch_id) - n AS before FROM sized)
    SELECT batch_id, n FROM running WHERE before < {COLLECT_TARGETS[-1]}""")
def stream_collect_until(spark, sf_dir):
    """Stopped at the first target, then gone on with from the same checkpoint to the second."""
    path, checkpoint = fresh_dir(spark, "until"), fresh_dir(spark, "until-checkpoint")
    for target in COLLECT_TARGETS:
        collect_until(message_stream(spark, sf_dir), target, path, checkpoint)
    return read_batches(spark, path).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@job("stream_custom_source", f"WITH {o.WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def stream_custom_source(spark, sf_dir):
    """Lines of the files that appear in a folder, by Spark's own text source."""
    lines = open_stream(spark, "files", file_format="text", path=line_files(spark, sf_dir))
    counts = textops.word_count(textops.tokenize(lines))
    return read_latest(spark, to_table(counts, "update", "custom", keys=["word"]), ["word"])


@job("stream_status_filter", f"""WITH {o.STATUS} SELECT id, lang, text FROM status
    WHERE contains(text, '#purchase') OR contains(text, '#t5')""")
def stream_status_filter(spark, sf_dir):
    rows = replay(spark, sf_dir, "status", status(spark, sf_dir).drop("createdAt"), "id", file_format="json")
    wanted = F.col("text").contains("#purchase") | F.col("text").contains("#t5")
    path = to_table(rows.filter(wanted).select("id", "user.lang", "text"), "append", "filtered")
    return read_batches(spark, path).drop("batch_id")


# --- stream-static joins ---------------------------------------------------------------------

ENDPOINTS = """endpoints AS (SELECT concat('/', CASE s_suppkey % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'view'
      WHEN 2 THEN 'purchase' WHEN 3 THEN 'signup' ELSE 'error' END, '/', CAST(s_suppkey % 20 AS VARCHAR(20))) AS website,
    min(s_name) AS owner FROM supplier GROUP BY 1)"""


@job("stream_join_dim_top", f"""{o.LOGS}, {ENDPOINTS} SELECT start, endpoint, owner, count(*) AS total,
    CAST(row_number() OVER (PARTITION BY start ORDER BY count(*) DESC, endpoint) AS INTEGER) AS place
    FROM {windowed("logs", "6 days")} JOIN endpoints ON endpoint = website
    GROUP BY start, endpoint, owner QUALIFY place <= 10""")
def stream_join_dim_top(spark, sf_dir):
    """Counted per window and endpoint first, so the join sees few rows and no hot key."""
    table(spark, sf_dir, "supplier").createOrReplaceTempView("supplier_rows")
    dim = spark.sql(f"WITH {ENDPOINTS.replace('FROM supplier', 'FROM supplier_rows')} SELECT * FROM endpoints")
    counts = panes(log_stream(spark, sf_dir), ["endpoint"], "6 days", watermark=LATE,
                   aggs=[F.count(F.lit(1)).alias("total")])
    joined = counts.join(dim, F.col("endpoint") == F.col("website")).drop("website", "end")
    rows = read_latest(spark, to_table(joined, "update", "dim", keys=["start", "endpoint", "owner"]), ["start", "endpoint", "owner"])
    return as_ntz(top_per_window(rows, "endpoint", 10, "total"))


@job("stream_tag_sentiment", f"""WITH {o.TAGS}, {o.LEXICON} SELECT start, substr(tag, 2) AS tag, count(*) AS n,
    count(*) * score AS weight FROM {windowed("tags", "2 days")} JOIN lexicon ON substr(tag, 2) = word
    GROUP BY start, tag, score""")
def stream_tag_sentiment(spark, sf_dir):
    tags = tag_stream(spark, sf_dir).withColumn("tag", F.expr("substr(tag, 2)"))
    counts = panes(tags, ["tag"], "2 days", watermark=LATE).drop("end")
    scored = (counts.join(lexicon(spark), F.col("tag") == F.col("word"))
              .select("start", "tag", "n", (F.col("n") * F.col("score")).alias("weight")))
    return as_ntz(read_latest(spark, to_table(scored, "update", "sentiment", keys=["start", "tag"]), ["start", "tag"]))
