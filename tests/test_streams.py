"""Batch and stream agree; windows, restarts, replays, late rows, sources."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from heronlake.operators import logs as log_ops
from heronlake.operators import text as text_ops
from heronlake.plans import ml as ml_jobs
from heronlake.plans import streams
from heronlake.registry import JOBS
from heronlake.session import fresh_dir
from heronlake.sources.jdbc import Slices, read_options
from heronlake.sources.tables import access_log, messages, status
from heronlake.streaming.replay import write_slices
from heronlake.streaming.runner import open_stream, read_batches, read_last, read_latest, run_available, to_table
from heronlake.streaming.state import (COUNT, Fold, collect_until, count_per_record, fold_by_key, sliding_counts,
                                       top_finished)
from heronlake.streaming.windows import count_windows, panes, seconds, slide_panes


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def tags(df):
    return text_ops.tag_rows(df.select("id", F.col("createdAt").alias("ts"), "text"))


def test_same_function_on_batch_and_stream(spark, sf_dir):
    batch = log_ops.count_by(log_ops.parse_access_log(access_log(spark, sf_dir)), "endpoint")
    stream = log_ops.count_by(streams.log_stream(spark, sf_dir), "endpoint")
    complete = read_last(spark, to_table(stream, "complete", "t"))
    update = read_latest(spark, to_table(stream, "update", "t"), ["endpoint"])
    assert rows_of(batch) == rows_of(complete) == rows_of(update)


@pytest.mark.parametrize("length,slide", [("2 days", "12 hours"), ("6 hours", "6 hours"), ("3 hours", "1 hour")])
def test_panes_equal_direct_windows(spark, sf_dir, length, slide):
    rows = tags(status(spark, sf_dir))
    direct = count_windows(rows, ["tag"], length, slide)
    by_panes = slide_panes(panes(rows, ["tag"], slide), ["tag"], length, slide)
    assert rows_of(direct) == rows_of(by_panes)


def test_chained_panes_in_append_mode(spark, sf_dir):
    """Append mode gives exactly the windows that are closed."""
    rows = tags(streams.status_stream(spark, sf_dir))
    chained = slide_panes(panes(rows, ["tag"], "12 hours", watermark="1 day", chain=True), ["tag"], "2 days", "12 hours")
    got = rows_of(read_batches(spark, to_table(chained, "append", "t")).drop("batch_id"))
    whole = count_windows(tags(status(spark, sf_dir)), ["tag"], "2 days", "12 hours")
    newest = status(spark, sf_dir).agg(F.max("createdAt")).first()[0]
    closed = rows_of(whole.filter(F.col("end") <= F.lit(newest - dt.timedelta(days=1))))
    assert got == closed


def test_slide_longer_than_window_is_an_error(spark, sf_dir):
    with pytest.raises(ValueError):
        count_windows(tags(status(spark, sf_dir)), ["tag"], "1 hour", "2 hours")
    with pytest.raises(ValueError):
        seconds("1 fortnight")


def test_restart(spark, sf_dir):
    """No new data: no batch. New data: the batch id and the counts go on."""
    source, path, checkpoint = (fresh_dir(spark, n) for n in ("in", "out", "cp"))
    rows = messages(spark, sf_dir)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run():
        stream = open_stream(spark, "files", schema, path=source)
        to_table(text_ops.word_count(text_ops.tokenize(stream)), "update", "t", path, checkpoint)
        return (read_latest(spark, path, ["word"]).agg(F.sum("n")).first()[0],
                read_batches(spark, path).agg(F.max("batch_id")).first()[0])

    write_slices(rows, "event_id", source, only=range(0, 2))
    first = run()
    assert run() == first
    write_slices(rows, "event_id", source, only=range(2, 3))
    total, last = run()
    assert total == 3 * rows.count() and last == first[1] + 1


def test_failed_batch_is_written_once(spark, sf_dir):
    source, path, checkpoint = (fresh_dir(spark, n) for n in ("in", "out", "cp"))
    rows = messages(spark, sf_dir).select("event_id", "value")
    write_slices(rows, "event_id", source)
    stream = open_stream(spark, "files", "event_id bigint, value string", path=source, maxFilesPerTrigger="1")
    fails = {"left": 1}

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if batch_id == 1 and fails["left"]:
            fails["left"] -= 1
            raise RuntimeError("lost after writing")

    with pytest.raises(Exception, match="lost after writing"):
        run_available(stream, "append", checkpoint, write)
    run_available(stream, "append", checkpoint, write)
    assert rows_of(read_batches(spark, path).drop("batch_id")) == rows_of(rows)


def test_collect_until_stops_and_resumes(spark, sf_dir):
    source, path, checkpoint = (fresh_dir(spark, n) for n in ("in", "out", "cp"))
    write_slices(messages(spark, sf_dir).select("event_id", "value"), "event_id", source, slices=5)
    stream = open_stream(spark, "files", "event_id bigint, value string", path=source, maxFilesPerTrigger="1")
    assert collect_until(stream, 300, path, checkpoint) == 400
    assert collect_until(stream, 300, path, checkpoint) == 400
    assert read_batches(spark, path).count() == 400
    assert collect_until(stream, 900, path, checkpoint) == 1000
    assert read_batches(spark, path).select("event_id").distinct().count() == 1000


def test_recent_rows_let_old_batches_go(spark, sf_dir):
    from heronlake.streaming.runner import batch_ids
    from heronlake.streaming.state import keep_recent

    source, path, checkpoint = (fresh_dir(spark, n) for n in ("in", "out", "cp"))
    rows = spark.range(100).select("id", F.timestamp_seconds(F.col("id") * 3600).alias("ts"))
    write_slices(rows, "id", source, slices=10)
    stream = open_stream(spark, "files", "id bigint, ts timestamp", path=source, maxFilesPerTrigger="1")
    keep_recent(stream, "ts", "1 day", path, checkpoint)
    assert batch_ids(spark, path) == [7, 8, 9]
    assert {r["id"] for r in read_batches(spark, path).collect()} == set(range(70, 100))


def test_many_small_batches_are_merged(spark):
    """300 batches: a reader opens one merged table and the batches after it."""
    from heronlake.streaming.runner import batch_writer

    path = fresh_dir(spark, "many")
    write = batch_writer(path, keys=["k"], merge_every=40)
    for i in range(300):
        write(spark.createDataFrame([(i % 7, i)], "k int, v int").coalesce(1), i)
    latest = read_latest(spark, path, ["k"])
    assert rows_of(latest) == sorted((k, max(i for i in range(300) if i % 7 == k)) for k in range(7))
    folders = {f.rsplit("/", 2)[1] for f in latest.inputFiles()}
    assert len(folders) <= 1 + 20


def slices_of(spark, df, order, slices, schema):
    """df as a stream of so many batches."""
    source = fresh_dir(spark, "in")
    write_slices(df, order, source, slices=slices, files=1)
    return open_stream(spark, "files", schema, path=source, maxFilesPerTrigger="1")


def test_hot_key_numbering_in_a_stream(spark, sf_dir):
    rows = streams.message_stream(spark, sf_dir).select("event_id", "ts", F.lit("one").alias("key"))
    path = fresh_dir(spark, "hot")
    count_per_record(rows, "key", ["ts", "event_id"], F.date_trunc("hour", "ts"), path, fresh_dir(spark, "cp"))
    got = read_batches(spark, path).orderBy("event_id").collect()
    assert [r["n"] for r in got] == list(range(1, len(got) + 1))


def test_running_counts_go_on_after_a_stop(spark):
    """Null keys count too, a start value is added once, and the state is Spark's: there is no folder of ours but the rows."""
    rows = spark.range(90).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 3)).alias("key"))
    source, path, checkpoint = (fresh_dir(spark, n) for n in ("in", "rows", "cp"))
    start = spark.createDataFrame([("k1", 100), ("never", 5)], "key string, n long")
    for part in (range(0, 2), range(2, 6)):
        write_slices(rows, "id", source, slices=6, files=1, only=part)
        stream = open_stream(spark, "files", "id bigint, key string", path=source, maxFilesPerTrigger="1")
        count_per_record(stream, "key", ["id"], F.expr("id div 4"), path, checkpoint, initial=start)
    got = {r["id"]: r["n"] for r in read_batches(spark, path).collect()}
    assert got == {i: i // 3 + 1 + (100 if i % 3 == 1 else 0) for i in range(90)}
    from heronlake.streaming.runner import batch_ids
    assert batch_ids(spark, path) == list(range(6))


def test_fold_with_merge_and_without(spark):
    """A sum of squares can be merged; the last value cannot, and follows the order asked for, not that of arrival."""
    rows = spark.range(200).select("id", (F.col("id") % 7 == 0).cast("string").alias("key"), (F.col("id") * 37 % 200).alias("at"),
                                   (F.col("id") * 1.5).alias("v"))
    shape = "id bigint, key string, at bigint, v double"
    squares = Fold("total double, n long", lambda: (0.0, 0), lambda s, f: (s[0] + float((f["v"] ** 2).sum()), s[1] + len(f)),
                   lambda a, b: (a[0] + b[0], a[1] + b[1]))
    last = Fold("v double, steps long", lambda: (None, 0), lambda s, f: (float(f["v"].iloc[-1]), s[1] + len(f)))
    plain = [(r["id"], r["key"], r["at"], r["v"]) for r in rows.collect()]

    def run(fold, **how):
        stream = slices_of(spark, rows.repartition(4), "id", 4, shape)
        return rows_of(read_latest(spark, to_table(fold_by_key(stream, "key", fold, **how), "update", "f", keys=["key"]), ["key"]))

    want = []
    for key in ("false", "true"):
        mine = [r for r in plain if r[1] == key]
        want.append((key, sum(r[3] ** 2 for r in mine), len(mine)))
    assert run(squares, columns=["v"]) == want
    start = spark.createDataFrame([("true", 1.0, 10), ("x", 2.0, 1)], "key string, total double, n long")
    assert run(squares, columns=["v"], initial=start) == [want[0], ("true", want[1][1] + 1, want[1][2] + 10)]
    got = run(last, columns=["v", "at"], order=["at"])
    for key, v, steps in got:
        newest = [r for r in plain if r[1] == key and r[0] >= 150]  # the last batch, by `at`
        assert v == max(newest, key=lambda r: r[2])[3] and steps == sum(r[1] == key for r in plain)


def test_states_before_a_batch(spark):
    stream = slices_of(spark, spark.range(40).select("id", F.lit("a").alias("key")), "id", 4, "id bigint, key string")
    path = to_table(fold_by_key(stream, "key", COUNT, before=True), "update", "b")
    assert [r["n"] for r in read_batches(spark, path).orderBy("batch_id").collect()] == [0, 10, 20, 30]


EVENTS = [("a", 10), ("a", 70), ("a", 71), ("b", 130), (None, 140), ("a", 600), ("c", 610), ("a", 1900), ("b", 1901)]


def minutes(spark, rows):
    return spark.createDataFrame(rows, "id long, key string, m long").select("id", "key", F.timestamp_seconds(F.col("m") * 60).alias("ts"))


def plain_windows(rows, size, step, last, keep=None):
    """(key, end in minutes, n), window by window."""
    out = []
    for key in {k for k, _ in rows}:
        mine = [m for k, m in rows if k == key]
        idle, begun = 0, False
        for end in range((min(mine) // step + 1) * step, last + 1, step):
            n = sum(end - size <= m < end for m in mine)
            if n:
                idle, begun = 0, True
            elif begun:
                idle += 1
                if keep is not None and idle > keep:
                    begun = False
            if begun:
                out.append((str(key), end, n))
    return sorted(out)


@pytest.mark.parametrize("keep,zeros", [(None, None), ("2 hours", 2)])
def test_ring_of_panes(spark, keep, zeros):
    """Every window once, with zeros, whatever the batches; rows that come too late are not counted."""
    rows = [(i, k, m) for i, (k, m) in enumerate(EVENTS)] + [(len(EVENTS), "end", 2_400), (len(EVENTS) + 1, "a", 12)]
    for slices in (1, len(rows)):
        stream = slices_of(spark, minutes(spark, rows), "id", slices, "id bigint, key string, ts timestamp").withWatermark("ts", "10 minutes")
        checkpoint = fresh_dir(spark, "cp")
        path = to_table(sliding_counts(stream, "key", "3 hours", "1 hour", keep=keep), "append", "ring", checkpoint=checkpoint)
        got = sorted((str(r["key"]), int(r["end"].timestamp()) // 60, r["n"]) for r in read_batches(spark, path).collect()
                     if r["key"] != "end")
        late = [("a", 12)] if slices == 1 else []  # in one batch nothing is late
        assert got == plain_windows(EVENTS + late, 180, 60, 2_390, zeros)
        if keep and slices > 1:
            held = spark.read.format("statestore").option("stateVarName", "ring").load(checkpoint)
            keys = {r["key"][0] for r in held.filter("value is not null").select("key").collect()}
            assert keys == {"end"}  # the others are let go


def test_ring_needs_whole_panes(spark):
    stream = slices_of(spark, minutes(spark, [(0, "a", 1)]), "id", 1, "id bigint, key string, ts timestamp")
    with pytest.raises(ValueError):
        sliding_counts(stream, "key", "3 hours", "2 hours")


def test_finished_windows_are_written_once(spark):
    """60 batches in append mode: no window is written twice, and only those not over are missing."""
    rows = [(i, f"w{i % 3}", i * 7) for i in range(60)]
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        stream = slices_of(spark, minutes(spark, rows), "id", 60, "id bigint, key string, ts timestamp")
        counts = count_windows(stream, ["key"], "2 hours", "1 hour", watermark="10 minutes")
        got = read_batches(spark, to_table(counts, "append", "w")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert len({r["batch_id"] for r in got}) > 4
    seen = sorted((int(r["end"].timestamp()) // 60, r["key"], r["n"]) for r in got)
    want = {}
    for _, key, m in rows:
        for end in range((m // 60 + 1) * 60, m + 121, 60):
            if end <= 59 * 7 - 10:
                want[end, key] = want.get((end, key), 0) + 1
    assert seen == sorted((*k, n) for k, n in want.items())


def test_best_of_a_finished_window(spark):
    """Two stateful steps in one query; ties go by name, a null name first."""
    words = ["b", "a", "a", None, "c", "c", "b", "d"] * 6
    rows = [(i, w, i) for i, w in enumerate(words)] + [(100, "late", 500)]
    for slices in (1, 5):
        stream = slices_of(spark, minutes(spark, rows), "id", slices, "id bigint, key string, ts timestamp")
        counts = count_windows(stream, ["key"], "12 minutes", watermark="1 minute")
        got = read_batches(spark, to_table(top_finished(counts, "key", 2), "append", "best")).collect()
        found = sorted((int(r["start"].timestamp()) // 60, r["place"], r["key"], r["n"]) for r in got)
        want = []
        for start in range(0, 48, 12):
            some = words[start:start + 12]
            ranked = sorted({w: some.count(w) for w in some}.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
            want += [(start, i + 1, w, n) for i, (w, n) in enumerate(ranked[:2])]
        assert found == want


def test_scoring_a_stream_equals_batch_scoring(spark, sf_dir):
    kept = JOBS["stream_cluster_filter"](spark, sf_dir)
    cluster = kept.first()["cluster"]
    batch = ml_jobs.clustered(spark, sf_dir).filter(F.col("cluster") == cluster).select("doc_id", "cluster")
    assert rows_of(kept.select("doc_id", "cluster")) == rows_of(batch)


def test_unknown_stream_kind(spark):
    with pytest.raises(ValueError):
        open_stream(spark, "carrier pigeon")


def test_jdbc_options():
    """No database is started here: the options are what is checked."""
    got = read_options("jdbc:x://h/db", query="SELECT * FROM p WHERE id > 3", driver="org.X",
                       slices=Slices("id", "0", "100", 4))
    assert got["dbtable"] == "(SELECT * FROM p WHERE id > 3) x" and got["driver"] == "org.X"
    assert (got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == ("id", "0", "100", "4")
    with pytest.raises(ValueError):
        read_options("jdbc:x://h/db")


def test_zero_rows_fill_the_gaps(spark):
    from heronlake.streaming.windows import keep_zero

    rows = spark.createDataFrame([("a", "2024-01-01 00:10:00"), ("a", "2024-01-01 05:10:00"),
                                  ("b", "2024-01-01 02:10:00")], "key string, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp"))

    def hours(keys):
        filled = keep_zero(count_windows(rows, keys, "1 hour"), keys, "1 hour", "1 hour")
        return sorted((*[r[k] for k in keys], r["start"].hour, r["n"]) for r in filled.collect())

    assert hours([]) == [(0, 1), (1, 0), (2, 1), (3, 0), (4, 0), (5, 1)]
    assert hours(["key"]) == [("a", 0, 1), ("a", 1, 0), ("a", 2, 0), ("a", 3, 0), ("a", 4, 0), ("a", 5, 1),
                              ("b", 2, 1), ("b", 3, 0), ("b", 4, 0), ("b", 5, 0)]
