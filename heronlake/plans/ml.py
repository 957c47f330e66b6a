"""Model jobs on the embeddings, documents and sales tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from heronlake.functions.hashing import mixed
from heronlake.operators import embed, factors, metrics, ml
from heronlake.operators.l1 import fit_l1
from heronlake.operators.vectors import nearest_all
from heronlake.plans import oracle as o
from heronlake.plans import reco
from heronlake.registry import job
from heronlake.session import fresh_dir, written_once
from heronlake.sources.tables import documents, table, vectors
from heronlake.streaming.replay import replay
from heronlake.streaming.runner import read_batches, to_table


def points(spark, sf_dir, binary: bool = False):
    label = (F.col("label") % 2 if binary else F.col("label")).cast("double")
    return ml.as_features(vectors(spark, sf_dir), "v").withColumn("label", label)


def split_points(spark, sf_dir, binary: bool = False):
    rows = ml.hash_split(points(spark, sf_dir, binary), "id", 0.6)
    return rows.filter("part = 'train'"), rows.filter("part = 'test'")


def labelled_text(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return documents(spark, sf_dir).select("doc_id", "text").join(labels, "doc_id")


TEST_ROWS = f"{o.mixed('vec_id')} % 1000000 >= 600000"


@job("ml_hash_split", f"SELECT vec_id AS id, CASE WHEN {TEST_ROWS} THEN 'test' ELSE 'train' END AS part FROM embeddings")
def ml_hash_split(spark, sf_dir):
    return ml.hash_split(vectors(spark, sf_dir).select("id"), "id", 0.6)


# --- classification -------------------------------------------------------------------

@job("ml_logreg_predict")
def ml_logreg_predict(spark, sf_dir):
    train, test = split_points(spark, sf_dir)
    return ml.fit_multinomial(train, 20).transform(test).select("id", "label", "prediction")


@job("ml_confusion")
def ml_confusion(spark, sf_dir):
    train, test = split_points(spark, sf_dir)
    return metrics.confusion(ml.fit_multinomial(train, 20).transform(test))


@job("ml_svm_scores")
def ml_svm_scores(spark, sf_dir):
    train, test = split_points(spark, sf_dir, binary=True)
    return ml.apply_svm(ml.fit_svm(train, 30), test).select("id", "label", "score")


@job("ml_svm_l1")
def ml_svm_l1(spark, sf_dir):
    """Area under ROC of the hard labels of an L1-penalised machine, threshold 0.5."""
    train, test = split_points(spark, sf_dir, binary=True)
    model = fit_l1(train, iterations=200, reg=0.1)
    score = ml.linear_score(model.weights, model.intercept, vector_to_array("features"))
    hard = test.select("label", F.when(score > 0.5, 1.0).otherwise(0.0).alias("score"))
    return metrics.auc(hard)


@job("ml_param_override")
def ml_param_override(spark, sf_dir):
    train, test = split_points(spark, sf_dir, binary=True)
    model = ml.fit_with_params(train, {"maxIter": 30, "regParam": 0.1, "threshold": 0.55,
                                       "probabilityCol": "my_probability"})
    return model.transform(test).select(
        "id", "label", "prediction", F.get(vector_to_array("my_probability"), F.lit(1)).alias("my_probability"))


# --- regression ---------------------------------------------------------------------------

@job("ml_linreg_mse", """WITH fit AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept
      FROM (SELECT l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem))
    SELECT round(slope, 4) AS slope, round(intercept, 4) AS intercept,
      round(avg((l_extendedprice / 1000 - slope * l_quantity - intercept) ** 2), 4) AS mse
    FROM lineitem, fit GROUP BY slope, intercept""")
def ml_linreg_mse(spark, sf_dir):
    rows = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(
        table(spark, sf_dir, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 1000).alias("label")))
    model = ml.fit_linear(rows, solver="normal")
    return metrics.regression_metrics(model.transform(rows)).select(
        F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(model.intercept)), 4).alias("intercept"), F.round("mse", 4).alias("mse"))


def sales_features(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", (F.col("l_extendedprice") / 1000).alias("label"))
    return VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(rows)


@job("ml_elasticnet_residuals")
def ml_elasticnet_residuals(spark, sf_dir):
    rows = sales_features(spark, sf_dir)
    model = ml.fit_elastic_net(rows)
    summary = model.summary
    residual = F.col("label") - F.col("prediction")
    return model.transform(rows).select(
        "l_orderkey", "l_linenumber", residual.alias("residual"),
        F.lit(summary.rootMeanSquaredError).alias("rmse"), F.lit(summary.r2).alias("r2"),
        F.lit(summary.totalIterations).alias("iterations"))


# --- clusters and components -----------------------------------------------------------------

def apart(spark, sf_dir):
    """Points in two groups set far apart by a first feature that tells even labels from odd ones."""
    rows = vectors(spark, sf_dir).withColumn("v", F.concat(F.array((F.col("label") % 2 * 1000).cast("double")), F.col("v")))
    return ml.as_features(rows, "v")


def apart_model(spark, sf_dir):
    return ml.fit_kmeans(apart(spark, sf_dir), 2, key="id")


GROUPS = "SELECT vec_id AS id, label % 2 AS grp, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"


@job("ml_kmeans_assign", f"SELECT id, min(id) OVER (PARTITION BY grp) AS cluster FROM ({GROUPS})")
def ml_kmeans_assign(spark, sf_dir):
    """Clusters named by their least member."""
    found = apart_model(spark, sf_dir).transform(apart(spark, sf_dir)).select("id", "prediction")
    names = found.groupBy("prediction").agg(F.min("id").alias("cluster"))
    return found.join(names, "prediction").select("id", "cluster")


@job("ml_kmeans_wssse", f"""WITH x AS (SELECT grp, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM ({GROUPS})),
    d AS (SELECT count(x) AS n, sum(x * x) - sum(x) * sum(x) / count(x) AS s FROM x GROUP BY grp, i)
    SELECT round(sum(s), 4) AS wssse, (SELECT count(*) FROM embeddings) AS n FROM d""")
def ml_kmeans_wssse(spark, sf_dir):
    """Squared distances to the centres, added up."""
    cost = ml.kmeans_cost(apart_model(spark, sf_dir), apart(spark, sf_dir), "v")
    return cost.select(F.round("wssse", 4).alias("wssse"), "n")


@job("ml_kmeans_centers_roundtrip", "SELECT CAST(2 AS BIGINT) AS centers, CAST(0 AS BIGINT) AS different, count(*) AS n FROM embeddings")
def ml_kmeans_centers_roundtrip(spark, sf_dir):
    rows = points(spark, sf_dir)
    model, path = ml.fit_kmeans(rows, 2, key="id"), fresh_dir(spark, "kmeans")
    model.write().overwrite().save(path)
    again = KMeansModel.load(path)
    both = again.setPredictionCol("again").transform(model.transform(rows))
    return both.agg(F.lit(len(again.clusterCenters())).cast("bigint").alias("centers"),
                    F.count(F.when(F.col("prediction") != F.col("again"), 1)).alias("different"),
                    F.count(F.lit(1)).alias("n"))


@job("ml_pmml_clusters", f"""SELECT CAST(min(id) AS BIGINT) AS first_member, max(len(v)) + 1 AS size,
      round(avg(v[1]), 6) AS second_value FROM ({GROUPS}) GROUP BY grp""")
def ml_pmml_clusters(spark, sf_dir):
    """The exported model read back: each centre with the least id among the points nearest to it."""
    path = fresh_dir(spark, "pmml")
    model = apart_model(spark, sf_dir)
    model.write().format("pmml").save(path)
    clusters = F.regexp_extract_all("value", F.lit(r'(?s)<Cluster name="cluster_(\d+)">.*?<Array[^>]*>([^<]*)</Array>'), 0)
    found = spark.read.text(path, wholetext=True).select(F.explode(clusters).alias("c")).select(
        F.regexp_extract("c", r"cluster_(\d+)", 1).cast("int").alias("prediction"),
        F.transform(F.split(F.trim(F.regexp_extract("c", r"<Array[^>]*>([^<]*)<", 1)), r"\s+"), lambda x: x.cast("double")).alias("v"))
    members = model.transform(apart(spark, sf_dir)).groupBy("prediction").agg(F.min("id").alias("first_member"))
    return found.join(members, "prediction").select("first_member", F.size("v").cast("long").alias("size"),
                                                    F.round(F.get("v", F.lit(1)), 6).alias("second_value"))


@job("ml_pca_project", f"""WITH p AS (SELECT id, v[1] AS x, v[2] AS y FROM ({GROUPS})),
    c AS (SELECT var_samp(x) AS a, var_samp(y) AS b, covar_samp(x, y) AS c FROM p),
    e AS (SELECT a, c, (a + b) / 2 + sqrt(((a - b) / 2) ** 2 + c * c) AS l FROM c),
    u AS (SELECT c / sqrt(c * c + (l - a) ** 2) AS ux, (l - a) / sqrt(c * c + (l - a) ** 2) AS uy FROM e)
    SELECT id, round(abs(x * ux + y * uy), 6) AS c1, round(abs(y * ux - x * uy), 6) AS c2 FROM p, u""")
def ml_pca_project(spark, sf_dir):
    """Projection of the first two columns on their components (not centred); the sign of a component is free."""
    rows = ml.as_features(vectors(spark, sf_dir).withColumn("v", F.slice("v", 1, 2)), "v")
    shown = vector_to_array("components")
    return ml.fit_pca(rows, 2).transform(rows).select(
        "id", F.round(F.abs(F.get(shown, F.lit(0))), 6).alias("c1"), F.round(F.abs(F.get(shown, F.lit(1))), 6).alias("c2"))


@job("ml_chisq_select", f"""WITH x AS (SELECT id, label, unnest(range(0, len(v))) AS i, unnest(v) > 0 AS x
      FROM (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)),
    cells AS (SELECT i, l.label, b.x, (SELECT count(*) FROM x WHERE x.i = f.i AND x.label = l.label AND x.x = b.x) AS n
      FROM (SELECT DISTINCT i FROM x) f, (SELECT DISTINCT label FROM x) l, (VALUES (true), (false)) b(x)),
    sums AS (SELECT *, sum(n) OVER (PARTITION BY i, label) * sum(n) OVER (PARTITION BY i, x)
      / sum(n) OVER (PARTITION BY i) AS expected FROM cells),
    best AS (SELECT i FROM sums GROUP BY i ORDER BY sum((n - expected) ** 2 / expected) DESC, i LIMIT 3)
    SELECT id, array_to_string(list(CAST(x AS INTEGER) ORDER BY i), ',') AS selected,
      array_to_string(list(i ORDER BY i), ',') AS features FROM x JOIN best USING (i) GROUP BY id""")
def ml_chisq_select(spark, sf_dir):
    """The three of 64 signs that depend most on the label; equal degrees of freedom, so the statistic decides."""
    signs = F.transform("v", lambda x: (x > 0).cast("double"))
    rows = points(spark, sf_dir).withColumn("features", array_to_vector(signs))
    model = ml.fit_chi_square(rows, 3)
    selected = F.transform(vector_to_array("selected"), lambda x: x.cast("int").cast("string"))
    return model.transform(rows).select(
        "id", F.array_join(selected, ",").alias("selected"),
        F.lit(",".join(str(i) for i in sorted(model.selectedFeatures))).alias("features"))


@job("ml_vector_assemble", """SELECT vec_id AS id, len(embedding) + 2 AS size, CAST(label AS DOUBLE) AS first_value,
    CAST(label AS DOUBLE) / 2 AS second_value, CAST(embedding[1] AS DOUBLE) AS third_value FROM embeddings""")
def ml_vector_assemble(spark, sf_dir):
    rows = points(spark, sf_dir).withColumn("half", F.col("label") / 2)
    out = VectorAssembler(inputCols=["label", "half", "features"], outputCol="all").transform(rows)
    v = vector_to_array("all")
    return out.select("id", F.size(v).cast("bigint").alias("size"), F.get(v, F.lit(0)).alias("first_value"),
                      F.get(v, F.lit(1)).alias("second_value"), F.get(v, F.lit(2)).alias("third_value"))


# --- text ---------------------------------------------------------------------------------------

def vectors_of_words(spark, sf_dir):
    """Vectors of the words of the lines, trained once."""
    def write(path):
        rows = ml.line_tokens(documents(spark, sf_dir).select(F.explode(F.split("text", "\n")).alias("value")))
        embed.word_vectors(rows, size=20, min_count=5, window=3, epochs=2).write.parquet(path)

    return spark.read.parquet(written_once(spark, sf_dir, "word-vectors", write))


@job("ml_word_vectors", f"WITH {o.WORDS} SELECT word, 20 AS size FROM words GROUP BY word HAVING count(*) >= 5")
def ml_word_vectors(spark, sf_dir):
    """The words that have vectors, and their length."""
    return vectors_of_words(spark, sf_dir).select("word", F.size("v").alias("size"))


@job("ml_word2vec_synonyms")
def ml_word2vec_synonyms(spark, sf_dir):
    """Five synonyms for every word of the vocabulary."""
    return nearest_all(vectors_of_words(spark, sf_dir), 5, dim=20)


def vectors_of_documents(spark, sf_dir):
    def write(path):
        docs = ml.line_tokens(documents(spark, sf_dir).select("doc_id", "text"), "text")
        vectors = embed.word_vectors(docs, size=3, min_count=0, window=3, epochs=1)
        embed.mean_vectors(docs, vectors, "doc_id", "words", 3).write.parquet(path)

    return spark.read.parquet(written_once(spark, sf_dir, "document-vectors", write))


@job("ml_doc_vectors")
def ml_doc_vectors(spark, sf_dir):
    """A vector of three numbers for each document, the mean over its words."""
    return vectors_of_documents(spark, sf_dir)


@job("ml_doc_vector_sizes", "SELECT doc_id, 3 AS size FROM documents")
def ml_doc_vector_sizes(spark, sf_dir):
    return vectors_of_documents(spark, sf_dir).select("doc_id", F.size("vector").alias("size"))


@job("ml_bigram_tf", "SELECT doc_id, CAST(greatest(length(text) - 1, least(length(text), 1)) AS DOUBLE) AS bigrams FROM documents")
def ml_bigram_tf(spark, sf_dir):
    """Hashed character pairs: the counts of a text add up to its number of pairs."""
    rows = ml.bigram_features(documents(spark, sf_dir).select("doc_id", "text"))
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda s, x: s + x)
    return rows.select("doc_id", total.alias("bigrams"))


def cluster_path(spark, sf_dir) -> str:
    return written_once(spark, sf_dir, "text-clusters", lambda path: ml.bigram_cluster_stages(100, key="doc_id").fit(
        documents(spark, sf_dir).select("doc_id", "text")).write().overwrite().save(path))


def clustered(spark, sf_dir):
    model = PipelineModel.load(cluster_path(spark, sf_dir))
    return model.transform(documents(spark, sf_dir).select("doc_id", "text"))


@job("ml_text_clusters")
def ml_text_clusters(spark, sf_dir):
    return clustered(spark, sf_dir).select("doc_id", "cluster")


@job("ml_text_cluster_sizes")
def ml_text_cluster_sizes(spark, sf_dir):
    """Size of each cluster and one of its texts."""
    rows = clustered(spark, sf_dir)
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min_by("text", "doc_id").alias("example"))


@job("stream_cluster_filter")
def stream_cluster_filter(spark, sf_dir):
    """The stream scored with the saved model; the texts of the largest cluster are kept."""
    sizes = clustered(spark, sf_dir).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    wanted = sizes.orderBy(F.desc("n"), "cluster").first()["cluster"]
    docs = documents(spark, sf_dir).select("doc_id", "text")
    stream = PipelineModel.load(cluster_path(spark, sf_dir)).transform(replay(spark, sf_dir, "documents", docs, "doc_id"))
    kept = to_table(stream.filter(F.col("cluster") == wanted).select("doc_id", "cluster"), "append", "cluster")
    return read_batches(spark, kept).drop("batch_id")


@job("ml_text_classes")
def ml_text_classes(spark, sf_dir):
    """Words to hashed counts to a classifier; the unfitted and the fitted pipeline are stored and loaded."""
    rows = ml.hash_split(labelled_text(spark, sf_dir), "doc_id", 0.6)
    plain, fitted = fresh_dir(spark, "stages"), fresh_dir(spark, "pipeline")
    ml.text_classifier().write().overwrite().save(plain)
    Pipeline.load(plain).fit(rows.filter("part = 'train'")).write().overwrite().save(fitted)
    scored = PipelineModel.load(fitted).transform(rows.filter("part = 'test'"))
    return scored.select("doc_id", "label", "prediction", F.get(vector_to_array("probability"), F.lit(1)).alias("score"))


@job("ml_model_roundtrip", f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS different FROM embeddings WHERE {TEST_ROWS}")
def ml_model_roundtrip(spark, sf_dir):
    from pyspark.ml.classification import LogisticRegressionModel

    train, test = split_points(spark, sf_dir)
    model, path = ml.fit_multinomial(train, 10), fresh_dir(spark, "logreg")
    model.write().overwrite().save(path)
    first = model.transform(test).select("features", F.col("prediction").alias("first"))
    both = LogisticRegressionModel.load(path).transform(first)
    return both.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("first") != F.col("prediction"), 1)).alias("different"))


# --- selection and explicit ratings -------------------------------------------------------------------

def fold_rows(spark, sf_dir):
    """Labelled texts with their fold, by a seeded hash of the id."""
    return labelled_text(spark, sf_dir).withColumn("fold", F.pmod(mixed(F.col("doc_id"), 3), F.lit(2)).cast("int"))


@job("ml_cv_grid_metrics")
def ml_cv_grid_metrics(spark, sf_dir):
    found, _ = ml.cross_validate(fold_rows(spark, sf_dir), "fold")
    return spark.createDataFrame(found, "buckets int, reg double, auc double")


@job("ml_tvs_grid_metrics")
def ml_tvs_grid_metrics(spark, sf_dir):
    found, _ = ml.train_validate(sales_features(spark, sf_dir).select("features", "label"))
    return spark.createDataFrame(found, "reg double, intercept boolean, mix double, rmse double")


@job("ml_als_explicit_mse")
def ml_als_explicit_mse(spark, sf_dir):
    rows = reco.ratings(spark, sf_dir)
    model = ml.fit_explicit(rows)
    both = factors.score(model, rows)
    return both.agg(F.avg(F.pow(F.col("rating") - F.col("prediction"), F.lit(2.0))).alias("mse"),
                    F.count(F.lit(1)).alias("n"))


@job("ml_logreg_accuracy")
def ml_logreg_accuracy(spark, sf_dir):
    train, test = split_points(spark, sf_dir)
    scored = ml.fit_multinomial(train, 20).transform(test)
    theirs = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(scored)
    return metrics.accuracy(scored).withColumn("evaluator", F.lit(theirs))
