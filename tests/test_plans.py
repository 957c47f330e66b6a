"""What the plans look like: no Python in the batch path, pruned scans, top-k without a full sort."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from heronlake.registry import JOBS, ORACLE
from heronlake.operators import relational
from heronlake.plans import logs, text
from heronlake.session import shared_root
from heronlake.sources.tables import people, projects, table
from heronlake.streaming.runner import open_stream
from heronlake.streaming.windows import count_windows

PYTHON_ON_PURPOSE = {"udf_website_suffix", "sales_discount_mapinpandas"}
BATCH = [k for k in sorted(ORACLE) if not k.startswith(("stream_", "ml_")) and k not in PYTHON_ON_PURPOSE]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH)
def test_no_python_and_no_cross_join(key, spark, sf_dir):
    text_of = plan(entry.queries()[key](spark, sf_dir))
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct"):
        assert node not in text_of, node
    loops = re.findall(r"BroadcastNestedLoopJoin.*", text_of)
    assert not loops


@pytest.mark.parametrize("key", ["log_top_endpoints", "word_count_top10", "reco_most_listened", "embedding_neighbors",
                                 "preview_rows", "log_top_endpoints_sql"])
def test_top_k_is_not_a_full_sort(key, spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(entry.queries()[key](spark, sf_dir))


def test_counts_are_combined_before_the_shuffle(spark, sf_dir):
    shown = plan(text.word_count(spark, sf_dir))
    assert shown.count("HashAggregate") >= 2 and "partial_count" in shown


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    shown = plan(table(spark, sf_dir, "orders").filter("o_custkey = 5").select("o_totalprice"))
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,5)]" in shown
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in shown


def test_log_report_reads_no_props(spark, sf_dir):
    assert "props" not in plan(logs.log_top_endpoints(spark, sf_dir)).split("ReadSchema")[-1]


def test_people_are_reduced_before_the_join(spark, sf_dir):
    shown = plan(relational.grouped_join_stats(people(spark, sf_dir), projects(spark, sf_dir)))
    assert shown.index("Join") < shown.index("partial_sum(age")


def test_top_k_per_window_is_cut_before_the_shuffle(spark, sf_dir):
    from heronlake.plans.streams import top_per_window

    counts = count_windows(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")),
                           ["event_type"], "1 day")
    assert "WindowGroupLimit" in plan(top_per_window(counts, "event_type", 2))


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_root(spark) == configured.rstrip("/")
    else:
        spark.conf.set("spark.checkpoint.dir", "/tmp/heronlake-shared/") if _settable(spark) else pytest.skip("fixed")
        try:
            assert shared_root(spark) == "/tmp/heronlake-shared"
        finally:
            spark.conf.unset("spark.checkpoint.dir")


def _settable(spark) -> bool:
    return spark.conf.isModifiable("spark.checkpoint.dir")


def test_stream_reader_needs_no_server_to_be_declared(spark, sf_dir):
    stream = open_stream(spark, "rate", rowsPerSecond="1")
    assert stream.isStreaming


def test_every_key_is_a_plain_name():
    keys = set(entry.queries())
    assert set(entry.oracle_sql()) <= keys
    assert not [k for k in JOBS if re.fullmatch(r"op\d+_.*", k)]
