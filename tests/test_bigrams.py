import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from heronlake.operators import bigrams, kmeans, ml
from heronlake.session import fresh_dir

TEXTS = ["", "a", "é", "😀", "ab", "a\r\nb", "日本語テキスト", "aé€😀ñ\n x", "😀😀😀", "a\x00b", "€a😀b" * 50, "the cat and the hat"]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")


def test_counts_are_those_of_spark(spark, texts, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("int"), "text")
    for buckets in (1000, 64):
        found = bigrams.HashedBigrams(outputCol="counts", numFeatures=buckets).transform(texts.union(docs))
        both = ml.bigram_features(found, buckets=buckets)
        assert both.filter("counts IS NULL OR counts != features").count() == 0 and both.count() == len(TEXTS) + docs.count()


def test_pieces_of_any_size_give_the_same(monkeypatch):
    column = bigrams.pa.array([*TEXTS, None])
    whole = bigrams.vectors(column, 100)
    for chars in (1, 20):
        monkeypatch.setattr(bigrams, "CHARS", chars)
        assert bigrams.vectors(column, 100).equals(whole)
    assert len(bigrams.vectors(column.slice(0, 0), 100)) == 0


def test_the_text_clusters_make_no_string_of_a_pair(spark, texts):
    """The plan of the scored texts holds neither pairs as strings nor a regular expression, also when the model is loaded."""
    model, path = ml.bigram_cluster_stages(3, key="doc_id").fit(texts), fresh_dir(spark, "bigram-clusters")
    model.write().overwrite().save(path)
    first, again = (m.transform(texts).select("doc_id", "cluster") for m in (model, PipelineModel.load(path)))
    assert sorted(first.collect()) == sorted(again.collect())
    assert "regexp_extract_all" not in again._jdf.queryExecution().optimizedPlan().toString()


def test_stored_vectors_become_rows(spark):
    rows = spark.createDataFrame([(0, [0.0, 2.0, 0.0]), (1, [1.5, 0.0, -3.0]), (2, [0.0, 0.0, 0.0])], "id int, v array<double>")
    sparse = bigrams.HashedBigrams(inputCol="t", outputCol="features", numFeatures=3).transform(
        spark.createDataFrame([(3, "abcab"), (4, "")], "id int, t string")).select("id", "features")
    both = ml.as_features(rows, "v").select("id", "features").union(sparse)
    path = fresh_dir(spark, "vectors")
    both.coalesce(1).write.parquet(path)
    stored = spark.read.schema(kmeans.STORED).parquet(path).toArrow().column(0).combine_chunks()
    want = spark.read.parquet(path).select(vector_to_array("features").alias("v")).toArrow().column(0).to_pylist()
    assert np.array_equal(kmeans.dense(stored, 3), np.array(want))
    assert np.array_equal(kmeans.dense(stored.slice(1, 3), 3), np.array(want)[1:4])
