"""Input tables and the record sets derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A small input in fewer pieces than there are cores is cut up before heavy work per row
    (for light work the extra shuffle costs more than it gives).

    Inputs with enough pieces, as all large ones have, are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def access_log(spark: SparkSession, sf_dir: str, malformed: bool = True) -> DataFrame:
    """Web-server log lines (event_id, ts, value); every 97th has a '-' size if malformed."""
    size = F.expr("cast(cast(round(value * 100) as bigint) as string)")
    if malformed:
        size = F.when(F.expr("event_id % 97 = 0"), "-").otherwise(size)
    code = F.expr("case event_type when 'error' then '500' when 'signup' then '201' else '200' end")
    return spread(table(spark, sf_dir, "events")).select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(
            F.lit("10.0."), F.expr("cast(user_id div 256 as string)"), F.lit("."),
            F.expr("cast(user_id % 256 as string)"), F.lit(" - u"), F.col("user_id").cast("string"),
            F.lit(" ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "GET /'),
            F.col("event_type"), F.lit("/"), F.expr("cast(event_id % 20 as string)"),
            F.lit(' HTTP/1.1" '), code, F.lit(" "), size,
        ).alias("value"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines (doc_id, line_no, value)."""
    return documents(spark, sf_dir).select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "value"))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten people to a name, whatever the size of the table."""
    return table(spark, sf_dir, "customer").select(
        F.expr("concat('N', cast(c_custkey div 10 as string))").alias("name"),
        F.expr("cast(floor(c_acctbal) as int) % 100").alias("age"),
        F.col("c_custkey").alias("id"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales records: transaction (order) id, line, customer, item, value."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_orderkey").alias("txn"), F.col("l_linenumber").alias("line"),
            F.col("o_custkey").cast("string").alias("customer"),
            F.col("l_partkey").cast("string").alias("item"),
            F.col("l_extendedprice").alias("value"))
    )


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.expr("""concat('http://site', cast(s_suppkey as string), '.',
                  case s_nationkey % 3 when 0 then 'org' when 1 then 'com' else 'net' end)""").alias("website"),
        F.expr("concat('N', cast(s_suppkey as string))").alias("manager"))


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("name"), F.col("o_orderdate").alias("date"),
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("amount"))


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listening counts (user, item, cnt); the same pair can occur more than once."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("item"),
            F.expr("cast(floor(l_quantity) as int)").alias("cnt"))
    )


def artist_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'id<tab>name' lines, some without a tab, with a bad id or with a tab in the name."""
    return table(spark, sf_dir, "part").select(F.expr("""
        case when p_partkey % 40 = 7 then p_name
             when p_partkey % 40 = 9 then concat('x', cast(p_partkey as string), '\t', p_name)
             when p_partkey % 40 = 11 then concat(cast(p_partkey as string), '\t', p_name, '\t', 'live')
             else concat(cast(p_partkey as string), '\t', p_name) end""").alias("value"))


def alias_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'bad id<tab>good id' lines, some with an empty bad id."""
    return table(spark, sf_dir, "part").filter("p_partkey % 25 = 0").select(F.expr("""
        case when p_partkey % 100 = 0 then concat('\t', cast(p_partkey as string))
             else concat(cast(p_partkey as string), '\t', cast(p_partkey - 1 as string)) end""").alias("value"))


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status messages with a nested user and hashtags in the text."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("createdAt"),
        F.struct(
            F.expr("case user_id % 4 when 0 then 'en' when 1 then 'fr' when 2 then 'de' else 'es' end").alias("lang"),
            F.expr("concat('u', cast(user_id as string))").alias("name")).alias("user"),
        F.expr("""concat('user ', cast(user_id as string), ' #', event_type, ' #t', cast(event_id % 13 as string),
                  case when event_id % 7 = 0 then ' plain#notag' else '' end)""").alias("text"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker-shaped rows: topic, partition, offset, time, blank-separated words."""
    return table(spark, sf_dir, "events").select(
        F.lit("log").alias("topic"), F.expr("event_id % 4").alias("part"),
        F.expr("event_id div 4").alias("offs"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
        F.expr("""concat(event_type, ' ', cast(user_id % 10 as string), ' ',
                  cast(event_id % 10 as string))""").alias("value"))


# The word scores and the blacklist of the trend and cleaning jobs.
LEXICON = [("click", 2), ("view", 1), ("purchase", 3), ("signup", 2), ("error", -3)]
BLACKLIST = ["the", "of", "and", "a"]


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "word string, score int")


def blacklist(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in BLACKLIST], "word string")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), "label")
