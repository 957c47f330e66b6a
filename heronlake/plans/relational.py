"""Record files, SQL reports, joins, averages and column operators in batch."""

from __future__ import annotations

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from heronlake.functions.text import after_last_dot
from heronlake.operators import relational as ops
from heronlake.operators.caching import cached
from heronlake.operators.ordering import concat_by, moving_avg
from heronlake.plans import oracle as o
from heronlake.registry import job
from heronlake.session import fresh_dir, written_once
from heronlake.sources import files
from heronlake.sources.tables import people, projects, sales, spend, status, table, vectors


# --- files -----------------------------------------------------------------

@job("scan_tsv_people", f"WITH {o.PEOPLE} SELECT name, age FROM people")
def scan_tsv_people(spark, sf_dir):
    path = written_once(spark, sf_dir, "people-tsv", lambda p: people(spark, sf_dir)
                        .select("name", "age").write.csv(p, sep="\t"))
    return files.read_delimited(spark, path, "name string, age int", sep="\t")


@job("scan_csv_sales", f"WITH {o.SALES} SELECT txn, customer, item, value FROM sales")
def scan_csv_sales(spark, sf_dir):
    path = written_once(spark, sf_dir, "sales-csv", lambda p: sales(spark, sf_dir)
                        .select("txn", "customer", "item", "value").write.csv(p))
    return files.read_delimited(spark, path, "txn bigint, customer string, item string, value double")


@job("scan_vector_lines", """SELECT CAST(label AS DOUBLE) AS label, len(v) AS size,
    round(list_sum(v), 6) AS total, v[1] AS first_value, v[len(v)] AS last_value
    FROM (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)""")
def scan_vector_lines(spark, sf_dir):
    def write(path):
        numbers = F.array_join(F.transform("v", lambda x: x.cast("string")), " ")
        files.write_lines(vectors(spark, sf_dir).select(
            F.concat(F.col("label").cast("string"), F.lit(","), numbers).alias("value")), path)

    rows = files.read_vectors(spark, written_once(spark, sf_dir, "vector-lines", write), labelled=True)
    rows = rows.select("label", vector_to_array("features").alias("v"))
    return rows.select(
        "label", F.size("v").cast("bigint").alias("size"),
        F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 6).alias("total"),
        F.get("v", F.lit(0)).alias("first_value"), F.element_at("v", -1).alias("last_value"))


@job("scan_libsvm", """SELECT CAST(label AS DOUBLE) AS label, i, count(*) AS n,
    count(*) FILTER (x <> 0) AS non_zero, round(sum(x), 5) AS total
    FROM (SELECT label, unnest(range(0, len(embedding))) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x
          FROM embeddings) GROUP BY ALL""")
def scan_libsvm(spark, sf_dir):
    from pyspark.ml.functions import array_to_vector

    path = written_once(spark, sf_dir, "libsvm", lambda p: vectors(spark, sf_dir).select(
        F.col("label").cast("double").alias("label"), array_to_vector("v").alias("features"))
        .write.format("libsvm").save(p))
    rows = files.read_libsvm(spark, path, num_features=64)
    cells = rows.select("label", F.posexplode(vector_to_array("features")).alias("i", "x"))
    return cells.groupBy("label", F.col("i").cast("bigint").alias("i")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("x") != 0, 1)).alias("non_zero"),
        F.round(F.sum("x"), 5).alias("total"))


STATUS_ROWS = f"WITH {o.STATUS}"


def status_json(spark, sf_dir) -> str:
    return written_once(spark, sf_dir, "status-json", lambda p: status(spark, sf_dir).withColumn(
        "createdAt", F.date_format("createdAt", "yyyy-MM-dd HH:mm:ss")).write.json(p))


@job("scan_json_status", f"""{STATUS_ROWS} SELECT id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
    lang, name, text FROM status""")
def scan_json_status(spark, sf_dir):
    schema = "createdAt string, id bigint, text string, user struct<lang: string, name: string>"
    rows = files.read_json(spark, status_json(spark, sf_dir), schema)
    return rows.select("id", F.col("createdAt").alias("created_at"), "user.lang", "user.name", "text")


@job("nested_projection", f"{STATUS_ROWS} SELECT lang, name, text FROM status")
def nested_projection(spark, sf_dir):
    status(spark, sf_dir).createOrReplaceTempView("status_rows")
    return spark.sql("SELECT user.lang, user.name, text FROM status_rows")


@job("lang_counts", f"{STATUS_ROWS} SELECT lang, count(*) AS cnt FROM status GROUP BY lang ORDER BY cnt DESC, lang LIMIT 25")
def lang_counts(spark, sf_dir):
    status(spark, sf_dir).createOrReplaceTempView("status_rows")
    return spark.sql("""SELECT user.lang AS lang, count(*) AS cnt FROM status_rows
                        GROUP BY user.lang ORDER BY cnt DESC, lang LIMIT 25""")


@job("status_epoch", f"{STATUS_ROWS} SELECT CAST(floor(epoch(created_at)) AS BIGINT) AS created_at, text FROM status")
def status_epoch(spark, sf_dir):
    return status(spark, sf_dir).select(F.unix_seconds("createdAt").alias("created_at"), "text")


@job("filter_like_text", f"{STATUS_ROWS} SELECT id, text FROM status WHERE text LIKE '%#purchase%'")
def filter_like_text(spark, sf_dir):
    return status(spark, sf_dir).select("id", "text").filter(F.col("text").like("%#purchase%"))


@job("row_to_json", f"""{STATUS_ROWS} SELECT id, lang, name, text FROM status""")
def row_to_json(spark, sf_dir):
    """Rows to JSON strings and back: what is parsed must be what was written."""
    rows = status(spark, sf_dir).select(F.to_json(F.struct("id", "user", "text")).alias("json"))
    back = F.from_json("json", "id bigint, user struct<lang:string,name:string>, text string").alias("r")
    return rows.select(back).select("r.id", "r.user.lang", "r.user.name", "r.text")


@job("json_pretty_sample", f"""{STATUS_ROWS} SELECT id, '{{' || chr(10) || '  "id" : ' || CAST(id AS VARCHAR) || ',' || chr(10)
    || '  "text" : "' || text || '"' || chr(10) || '}}' AS pretty FROM status ORDER BY id LIMIT 5""")
def json_pretty_sample(spark, sf_dir):
    rows = status(spark, sf_dir).select("id", "text").orderBy("id").limit(5)
    return rows.select("id", F.to_json(F.struct("id", "text"), {"pretty": "true"}).alias("pretty"))


@job("preview_rows", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 10")
def preview_rows(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", "value").orderBy("event_id").limit(10)


@job("column_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct,
        CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM customer"""
    for c in ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]))
def column_profile(spark, sf_dir):
    return ops.column_profile(table(spark, sf_dir, "customer"))


@job("cache_snapshot", f"""WITH {o.PEOPLE} SELECT count(*) AS cached_rows, 2 * count(*) AS fresh_rows FROM people""")
def cache_snapshot(spark, sf_dir):
    """A cached table keeps its snapshot while the files grow; a new read sees all rows."""
    path = fresh_dir(spark, "snapshot")
    rows = people(spark, sf_dir)
    rows.write.parquet(f"{path}/load=1")
    with cached(spark.read.parquet(path)) as snapshot:
        snapshot.count()
        rows.write.parquet(f"{path}/load=2")
        kept = snapshot.count()
    return spark.read.parquet(path).agg(F.lit(kept).cast("bigint").alias("cached_rows"), F.count(F.lit(1)).alias("fresh_rows"))


# --- averages and windows ----------------------------------------------------

@job("avg_age_int", f"WITH {o.PEOPLE} SELECT name, CAST(sum(age) // count(age) AS BIGINT) AS avg_age FROM people GROUP BY name")
def avg_age_int(spark, sf_dir):
    return ops.mean_by_key(people(spark, sf_dir), "name", "age", integer=True)


@job("avg_age_sql", f"WITH {o.PEOPLE} SELECT name, round(avg(age), 6) AS avg_age FROM people GROUP BY name")
def avg_age_sql(spark, sf_dir):
    people(spark, sf_dir).createOrReplaceTempView("people")
    return spark.sql("SELECT name, round(avg(age), 6) AS avg_age FROM people GROUP BY name")


@job("moving_avg_spend", """SELECT o_custkey AS name, o_orderkey AS order_id, o_orderdate AS date,
    round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
      ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 4) AS moving_avg FROM orders""")
def moving_avg_spend(spark, sf_dir):
    averaged = moving_avg(spend(spark, sf_dir), ["name"], ["date", "order_id"], "amount",
                          bucket=F.struct("date", F.expr("order_id div 1000000")))
    return averaged.select("name", "order_id", "date", F.round("moving_avg", 4).alias("moving_avg"))


# --- sales -------------------------------------------------------------------

@job("sales_total", f"WITH {o.SALES} SELECT round(sum(value), 2) AS total FROM sales")
def sales_total(spark, sf_dir):
    return sales(spark, sf_dir).agg(F.round(F.sum("value"), 2).alias("total"))


@job("sales_customers_concat", f"""WITH {o.SALES}, numbered AS (SELECT item, customer,
      row_number() OVER (PARTITION BY item ORDER BY txn, line) - 1 AS pos FROM sales)
    SELECT item, pos // 1000 AS chunk_no, count(*) AS n, string_agg(customer, '+' ORDER BY pos) AS joined
    FROM numbered GROUP BY item, pos // 1000""")
def sales_customers_concat(spark, sf_dir):
    return concat_by(sales(spark, sf_dir), ["item"], "customer", ["txn", "line"],
                     bucket=F.expr("txn div 1000000"))


@job("sales_item_suffix", f"WITH {o.SALES} SELECT txn, line, concat(item, '_x') AS item FROM sales")
def sales_item_suffix(spark, sf_dir):
    return sales(spark, sf_dir).select("txn", "line", F.concat("item", F.lit("_x")).alias("item"))


@job("sales_discount_rate", f"WITH {o.SALES} SELECT txn, line, round(value * 0.1, 6) AS discount FROM sales")
def sales_discount_rate(spark, sf_dir):
    return (sales(spark, sf_dir).transform(ops.discount, "value", rate=0.1)
            .select("txn", "line", F.round("discount", 6).alias("discount")))


@job("sales_discount_pct", f"WITH {o.SALES} SELECT txn, line, round(value * 5.0 / 100.0, 6) AS discount FROM sales")
def sales_discount_pct(spark, sf_dir):
    return (sales(spark, sf_dir).transform(ops.discount, "value", pct=5.0)
            .select("txn", "line", F.round("discount", 6).alias("discount")))


def discount_batches(batches):
    """User code over the record batches of a partition; the way out when no column function fits."""
    for batch in batches:
        yield pd.DataFrame({"txn": batch["txn"], "line": batch["line"], "discount": batch["value"] * 0.1})


@job("sales_discount_mapinpandas", f"WITH {o.SALES} SELECT txn, line, round(value * 0.1, 6) AS discount FROM sales")
def sales_discount_mapinpandas(spark, sf_dir):
    rows = sales(spark, sf_dir).select("txn", "line", "value")
    return (rows.mapInPandas(discount_batches, "txn bigint, line int, discount double")
            .withColumn("discount", F.round("discount", 6)))


# --- projects and joins --------------------------------------------------------

@job("col_new_id", f"WITH {o.PROJECTS} SELECT id, name, id + 100 AS new_id FROM projects")
def col_new_id(spark, sf_dir):
    return projects(spark, sf_dir).select("id", "name").withColumn("new_id", F.col("id") + 100)


SUFFIX = f"""WITH {o.PROJECTS} SELECT id, list_last(string_split(website, '.')) AS suffix FROM projects"""


@job("website_suffix", SUFFIX)
def website_suffix(spark, sf_dir):
    return projects(spark, sf_dir).select("id", after_last_dot(F.col("website")).alias("suffix"))


@pandas_udf(StringType())
def suffix_udf(website: pd.Series) -> pd.Series:
    return website.str.rsplit(".", n=1).str[-1]


@job("udf_website_suffix", SUFFIX)
def udf_website_suffix(spark, sf_dir):
    """A user function from SQL; `website_suffix` is the built-in form."""
    spark.udf.register("website_suffix", suffix_udf)
    projects(spark, sf_dir).createOrReplaceTempView("projects")
    return spark.sql("SELECT id, website_suffix(website) AS suffix FROM projects")


@job("filter_age", f"WITH {o.PEOPLE} SELECT name, age FROM people WHERE age > 11")
def filter_age(spark, sf_dir):
    return people(spark, sf_dir).select("name", "age").filter("age > 11")


@job("sql_where_id", f"WITH {o.PROJECTS} SELECT id, name, website, manager FROM projects WHERE id > 3")
def sql_where_id(spark, sf_dir):
    projects(spark, sf_dir).createOrReplaceTempView("projects")
    return spark.sql("SELECT * FROM projects WHERE id > 3")


@job("sql_view_query", f"WITH {o.PROJECTS} SELECT manager, count(*) AS n FROM projects GROUP BY manager")
def sql_view_query(spark, sf_dir):
    projects(spark, sf_dir).createOrReplaceTempView("projects")
    return spark.table("projects").groupBy("manager").agg(F.count(F.lit(1)).alias("n"))


JOINED = f"""WITH {o.PEOPLE}, {o.PROJECTS}"""
ON = "FROM people p JOIN projects j ON p.name = j.manager WHERE p.age > 11"


@job("join_people_projects", f"{JOINED} SELECT p.id AS person_id, p.name, p.age, j.id, j.website {ON}")
def join_people_projects(spark, sf_dir):
    left = people(spark, sf_dir).filter("age > 11").withColumnRenamed("id", "person_id")
    right = projects(spark, sf_dir).select("id", "website", "manager")
    return (left.join(right, left["name"] == right["manager"], "inner")
            .select("person_id", "name", "age", "id", "website"))


@job("join_group_count", f"{JOINED} SELECT j.website, count(*) AS n {ON} GROUP BY j.website")
def join_group_count(spark, sf_dir):
    adults = people(spark, sf_dir).filter("age > 11")
    return ops.grouped_join_stats(adults, projects(spark, sf_dir)).select("website", "n")


GROUP_AGG = f"{JOINED} SELECT j.website, round(avg(p.age), 6) AS avg_age, max(j.id) AS max_id {ON} GROUP BY j.website"


@job("join_group_agg", GROUP_AGG)
def join_group_agg(spark, sf_dir):
    adults = people(spark, sf_dir).filter("age > 11")
    return (ops.grouped_join_stats(adults, projects(spark, sf_dir))
            .select("website", F.round("avg_age", 6).alias("avg_age"), "max_id"))


@job("join_people_projects_sql", GROUP_AGG)
def join_people_projects_sql(spark, sf_dir):
    people(spark, sf_dir).createOrReplaceTempView("people")
    projects(spark, sf_dir).createOrReplaceTempView("projects")
    return spark.sql("""
        WITH per_name AS (SELECT name, sum(age) AS total, count(age) AS n FROM people WHERE age > 11 GROUP BY name)
        SELECT website, round(sum(total) / sum(n), 6) AS avg_age, max(id) AS max_id
        FROM projects JOIN per_name ON projects.manager = per_name.name GROUP BY website""")


@job("count_star_nonnull", """SELECT event_type, count(*) FILTER (event_id IS NOT NULL AND score IS NOT NULL) AS total
    FROM (SELECT event_type, event_id, CASE WHEN event_id % 97 <> 0 THEN value END AS score FROM events)
    GROUP BY event_type""")
def count_star_nonnull(spark, sf_dir):
    """COUNT of all columns counts the rows in which every one of them is non-null."""
    table(spark, sf_dir, "events").select(
        "event_type", "event_id", F.expr("CASE WHEN event_id % 97 <> 0 THEN value END AS score")
    ).createOrReplaceTempView("scored")
    return spark.sql("SELECT event_type, count(event_type, event_id, score) AS total FROM scored GROUP BY event_type")
