"""Small inputs with known results, edge cases of the text functions."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from heronlake.functions.text import after_last_dot, char_ngrams, hashtags, java_split, ngrams, normalize_text
from heronlake.functions.vectors import cosine, to_dense, to_sparse
from heronlake.operators import logs, ml, relational
from heronlake.operators import reco as reco_ops
from heronlake.operators.ordering import moving_avg
from heronlake.plans.text import digit_messages

# Inputs and results of the worked examples.
SPEND = [("Alice", "2016-05-01", 50.0, 47.5), ("Alice", "2016-05-03", 45.0, 50.0), ("Alice", "2016-05-04", 55.0, 50.0),
         ("Bob", "2016-05-01", 25.0, 27.0), ("Bob", "2016-05-04", 29.0, 27.0), ("Bob", "2016-05-06", 27.0, 28.0)]
PCA_ROWS = [(Vectors.sparse(5, [(1, 1.0), (3, 7.0)]),), (Vectors.dense(2.0, 0.0, 3.0, 4.0, 5.0),),
            (Vectors.dense(4.0, 0.0, 0.0, 6.0, 7.0),)]
PCA_RESULT = [(1.648573, -4.013283), (-4.645104, -1.116797), (-6.428881, -5.337951)]
CHI_ROWS = [(7, Vectors.dense(0.0, 0.0, 18.0, 1.0), 1.0), (8, Vectors.dense(0.0, 1.0, 12.0, 0.0), 0.0),
            (9, Vectors.dense(1.0, 0.0, 15.0, 0.1), 0.0)]
TEXTS = [(0, "a b c d e spark", 1.0), (1, "b d", 0.0), (2, "spark f g h", 1.0), (3, "hadoop mapreduce", 0.0),
         (4, "b spark who", 1.0), (5, "g d a y", 0.0), (6, "spark fly", 1.0), (7, "was mapreduce", 0.0),
         (8, "e spark program", 1.0), (9, "a e c l", 0.0), (10, "spark compile", 1.0), (11, "hadoop software", 0.0)]
TEXT_TESTS = [(4, "spark i j k"), (5, "l m n"), (6, "mapreduce spark"), (7, "apache hadoop")]
LR_TRAIN = [(1.0, Vectors.dense(0.0, 1.1, 0.1)), (0.0, Vectors.dense(2.0, 1.0, -1.0)),
            (0.0, Vectors.dense(2.0, 1.3, 1.0)), (1.0, Vectors.dense(0.0, 1.2, -0.5))]
LR_TEST = [(1.0, Vectors.dense(-1.0, 1.5, 1.3)), (0.0, Vectors.dense(3.0, 2.0, -0.1)),
           (1.0, Vectors.dense(0.0, 2.2, -1.5))]


def test_moving_average(spark):
    df = spark.createDataFrame([r[:3] for r in SPEND], "name string, date string, amount double")
    out = moving_avg(df, ["name"], ["date"], "amount", F.col("date"), chunk=2)
    assert sorted(tuple(r) for r in out.select("name", "date", "amount", "moving_avg").collect()) == sorted(SPEND)


def test_pca(spark):
    rows = ml.fit_pca(spark.createDataFrame(PCA_ROWS, ["features"]), 2)
    got = [r[0].toArray() for r in rows.transform(spark.createDataFrame(PCA_ROWS, ["features"]))
           .select("components").collect()]
    for axis in (0, 1):
        sign = math.copysign(1, got[0][axis] * PCA_RESULT[0][axis])
        for g, w in zip(got, PCA_RESULT):
            assert g[axis] * sign == pytest.approx(w[axis], abs=1e-5)


def test_chi_square(spark):
    df = spark.createDataFrame(CHI_ROWS, ["id", "features", "label"])
    assert sorted(ml.fit_chi_square(df, 3).selectedFeatures) == [0, 2, 3]


def test_assembler(spark):
    df = spark.createDataFrame([(0, 18, 1.0, Vectors.dense(0.0, 10.0, 0.5), 1.0)],
                               ["id", "hour", "mobile", "userFeatures", "clicked"])
    out = VectorAssembler(inputCols=["hour", "mobile", "userFeatures"], outputCol="features").transform(df)
    assert out.select(vector_to_array("features")).first()[0] == [18.0, 1.0, 0.0, 10.0, 0.5]


def test_text_pipeline(spark):
    model = ml.text_classifier().fit(spark.createDataFrame(TEXTS, "id long, text string, label double"))
    out = model.transform(spark.createDataFrame(TEXT_TESTS, "id long, text string"))
    assert [r["prediction"] for r in out.orderBy("id").collect()] == [1.0, 0.0, 1.0, 0.0]


def test_overridden_parameters(spark):
    train = spark.createDataFrame(LR_TRAIN, ["label", "features"])
    model = ml.fit_with_params(train, {"maxIter": 30, "regParam": 0.1, "threshold": 0.55,
                                       "probabilityCol": "my_probability"})
    out = model.transform(spark.createDataFrame(LR_TEST, ["label", "features"]))
    assert [r["prediction"] for r in out.collect()] == [1.0, 0.0, 1.0]
    assert "my_probability" in out.columns and "probability" not in out.columns


def test_suffix(spark):
    df = spark.createDataFrame([("http://spark.apache.org",), ("nodot",)], "w string")
    assert [r[0] for r in df.select(after_last_dot(F.col("w"))).collect()] == ["org", "nodot"]


def jvm_split(text: str, sep: str) -> list[str]:
    parts = text.split(sep)
    if text and not text.strip(sep):
        return []
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a b.é", max_size=8), min_size=1, max_size=40))
def test_split_like_the_jvm(spark, texts):
    texts = [*texts, "", "   ", "a  b ", " a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", java_split(F.col("t")).alias("s"), java_split(F.col("t"), ".").alias("d")).collect()
    for row in got:
        assert row["s"] == jvm_split(row["t"], " ")
        assert row["d"] == jvm_split(row["t"], ".")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abé 😀", max_size=6), min_size=1, max_size=40))
def test_character_pairs(spark, texts):
    df = spark.createDataFrame([(t,) for t in [*texts, "", "x", "xy", "😀", "😀a", "a😀😀b"]], "t string")
    for row in df.select("t", char_ngrams(F.col("t")).alias("g")).collect():
        t = row["t"]
        assert row["g"] == ([t] if len(t) == 1 else [t[i:i + 2] for i in range(len(t) - 1)])


def test_text_functions(spark):
    df = spark.createDataFrame([("x #a plain#no #", "Soooo goooood!!!!")], "t string, u string")
    row = df.select(hashtags(F.col("t")).alias("tags"), hashtags(F.col("t"), True).alias("bare"),
                    normalize_text(F.col("u")).alias("normal"),
                    ngrams(F.array(*map(F.lit, "a b c".split())), 2).alias("two"),
                    ngrams(F.array(F.lit("a")), 2).alias("none")).first()
    assert row["tags"] == ["#a", "#"] and row["bare"] == ["a", ""]
    assert row["normal"] == "soo good!!"
    assert row["two"] == ["a b", "b c"] and row["none"] == []


GOOD = '64.2.1.9 - u1 [08/Mar/2004:09:01:35 -0800] "GET /twiki/bin HTTP/1.1" 401 12846 trailing text'
BAD = ['64.2.1.9 - u1 [08/Mar/2004:09:01:35 -0800] "GET /twiki/bin HTTP/1.1" 401 -', "", "garbage",
       '64.2.1.9 - u1 [08/Mar/2004:09:01:35 -0800] "GET /x HTTP/1.1" 401 99999999999999999999']


def test_log_modes(spark):
    df = spark.createDataFrame([(t,) for t in [GOOD, *BAD]], "value string")
    kept = logs.parse_access_log(df).collect()
    assert [tuple(r) for r in kept] == [("64.2.1.9", "-", "u1", "08/Mar/2004:09:01:35 -0800", "GET", "/twiki/bin",
                                         "HTTP/1.1", 401, 12846)]
    assert logs.parse_access_log(df, "permissive").filter("_corrupt is null").count() == 1
    assert sorted(r[0] for r in logs.rejects(df).collect()) == sorted(BAD)
    assert logs.parse_access_log(df.filter(F.col("value") == GOOD), "failfast").count() == 1
    with pytest.raises(PySparkException, match="Cannot parse log line"):
        logs.parse_access_log(df, "failfast").collect()
    with pytest.raises(ValueError):
        logs.parse_access_log(df, "other")


def test_integer_mean_truncates_toward_zero(spark):
    df = spark.createDataFrame([("a", -3), ("a", -4), ("b", 7), ("b", 8)], "name string, age int")
    got = {r["name"]: r["avg_age"] for r in relational.mean_by_key(df, "name", "age", integer=True).collect()}
    assert got == {"a": -3, "b": 7}


def test_discount_needs_one_argument(spark):
    df = spark.createDataFrame([(200.0,)], "value double")
    assert relational.discount(df, "value", rate=0.1).first()["discount"] == pytest.approx(20.0)
    assert relational.discount(df, "value", pct=10).first()["discount"] == pytest.approx(20.0)
    with pytest.raises(ValueError):
        relational.discount(df, "value")


def test_artist_and_alias_lines(spark):
    lines = spark.createDataFrame([(v,) for v in ["1\tOne", "2\t Two\tlive ", "x3\tThree", "none", "4\t"]], "value string")
    assert sorted(tuple(r) for r in reco_ops.artists(lines).collect()) == [(1, "One"), (2, "Two\tlive")]
    pairs = spark.createDataFrame([(v,) for v in ["1\t2", "\t5", "7", "8\tx"]], "value string")
    assert [tuple(r) for r in reco_ops.aliases(pairs).collect()] == [(1, 2)]


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0, 2.0], [0.0, 0.0, 0.0])], "a array<double>, z array<double>")
    row = df.select(cosine(F.col("a"), F.col("a")).alias("one"), cosine(F.col("a"), F.col("z")).alias("none"),
                    to_sparse(F.col("a")).alias("s"), to_dense(to_sparse(F.col("z"))).alias("back")).first()
    assert row["one"] == pytest.approx(1.0) and row["none"] is None
    assert row["s"]["indices"] == [0, 2] and row["s"]["values"] == [1.0, 2.0]
    assert row["back"] == [0.0, 0.0, 0.0]


def test_digit_messages(spark):
    row = digit_messages(spark.range(5), "id", 20).orderBy("id").first()
    assert len(row["value"].split(" ")) == 20 and set(row["value"]) <= set("0123456789 ")
