"""Log reports in batch."""

from __future__ import annotations

from heronlake.operators import logs as ops
from heronlake.plans.oracle import CLEAN_LOGS, LOGS, RAW_LOG, LINE
from heronlake.registry import job
from heronlake.sources.tables import access_log

IP_THRESHOLD = 66
FIELD_LIST = ", ".join(["event_id", *ops.FIELDS])


def parsed(spark, sf_dir):
    return ops.parse_access_log(access_log(spark, sf_dir))


@job("log_parse_strict", f"{CLEAN_LOGS} SELECT {FIELD_LIST} FROM logs")
def log_parse_strict(spark, sf_dir):
    lines = access_log(spark, sf_dir, malformed=False)
    return ops.parse_access_log(lines, "failfast").drop("ts")


@job("log_parse_tolerant", f"{LOGS} SELECT {FIELD_LIST} FROM logs")
def log_parse_tolerant(spark, sf_dir):
    return parsed(spark, sf_dir).drop("ts")


@job("log_parse_rejects",
     f"WITH {RAW_LOG} SELECT event_id, value FROM raw_log WHERE NOT regexp_matches(value, '{LINE}')")
def log_parse_rejects(spark, sf_dir):
    return ops.rejects(access_log(spark, sf_dir)).drop("ts")


@job("log_content_stats", f"""{LOGS} SELECT CAST(sum(content_size) // count(*) AS BIGINT) AS avg_size,
    round(avg(content_size), 6) AS mean_size, min(content_size) AS min_size, max(content_size) AS max_size FROM logs""")
def log_content_stats(spark, sf_dir):
    return ops.content_stats(parsed(spark, sf_dir))


@job("log_content_stats_sql", f"""{LOGS} SELECT CAST(sum(content_size) AS BIGINT) AS total, count(*) AS n,
    min(content_size) AS min_size, max(content_size) AS max_size FROM logs""")
def log_content_stats_sql(spark, sf_dir):
    parsed(spark, sf_dir).createOrReplaceTempView("log_rows")
    return spark.sql("""SELECT sum(content_size) AS total, count(*) AS n, min(content_size) AS min_size,
                        max(content_size) AS max_size FROM log_rows""")


@job("stat_counter", f"""{LOGS} SELECT count(content_size) AS cnt, round(avg(content_size), 6) AS mean,
    round(stddev_pop(content_size), 6) AS stdev, max(content_size) AS max_value,
    min(content_size) AS min_value FROM logs""")
def stat_counter(spark, sf_dir):
    return ops.stat_counter(parsed(spark, sf_dir), "content_size")


@job("log_response_codes", f"{LOGS} SELECT response_code, count(*) AS n FROM logs GROUP BY response_code")
def log_response_codes(spark, sf_dir):
    return ops.count_by(parsed(spark, sf_dir), "response_code")


FREQUENT = f"SELECT ip_address, count(*) AS n FROM logs GROUP BY ip_address HAVING count(*) > {IP_THRESHOLD}"


@job("log_frequent_ips", f"{LOGS} {FREQUENT}")
def log_frequent_ips(spark, sf_dir):
    return ops.frequent(parsed(spark, sf_dir), "ip_address", IP_THRESHOLD)


@job("log_frequent_ips_sql", f"{LOGS} {FREQUENT}")
def log_frequent_ips_sql(spark, sf_dir):
    parsed(spark, sf_dir).createOrReplaceTempView("log_rows")
    return spark.sql(f"""SELECT ip_address, count(*) AS n FROM log_rows GROUP BY ip_address
                         HAVING n > {IP_THRESHOLD}""")


TOP = f"{LOGS} SELECT endpoint, count(*) AS n FROM logs GROUP BY endpoint ORDER BY n DESC, endpoint LIMIT 10"


@job("log_top_endpoints", TOP)
def log_top_endpoints(spark, sf_dir):
    return ops.top_endpoints(parsed(spark, sf_dir), 10)


@job("log_top_endpoints_sql", TOP)
def log_top_endpoints_sql(spark, sf_dir):
    parsed(spark, sf_dir).createOrReplaceTempView("log_rows")
    return spark.sql("""SELECT endpoint, count(*) AS n FROM log_rows GROUP BY endpoint
                        ORDER BY n DESC, endpoint LIMIT 10""")
