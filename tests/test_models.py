"""Fitted models: agreement with other ways to get the same numbers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from heronlake.operators import metrics, ml
from heronlake.operators import reco as reco_ops
from heronlake.operators.l1 import fit_l1, soft
from heronlake.plans import ml as ml_jobs
from heronlake.plans import reco as reco_jobs
from heronlake.registry import JOBS


def test_accuracy_equals_the_evaluator(spark, sf_dir):
    row = JOBS["ml_logreg_accuracy"](spark, sf_dir).first()
    assert row["accuracy"] == pytest.approx(row["evaluator"])


def test_confusion_counts_every_row(spark, sf_dir):
    _, test = ml_jobs.split_points(spark, sf_dir)
    assert JOBS["ml_confusion"](spark, sf_dir).agg(F.sum("n")).first()[0] == test.count()


def test_area_under_roc_equals_the_evaluator(spark, sf_dir):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    train, test = ml_jobs.split_points(spark, sf_dir, binary=True)
    scored = ml.apply_svm(ml.fit_svm(train, 10), test)
    ours = metrics.auc(scored).first()["auc"]
    assert ours == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(scored))


def hinge_l1(x, y, w, reg):
    return np.maximum(1 - np.where(y > 0, 1, -1) * (x @ w), 0).mean() + reg * np.abs(w).sum()


def test_l1_machine_scores_are_those_of_its_weights(spark, sf_dir):
    """The area of the job, from scores computed again from the weights, row by row; the objective from the rows."""
    train, test = ml_jobs.split_points(spark, sf_dir, binary=True)
    model = fit_l1(train, iterations=200, reg=0.1)
    rows = train.select("v", "label").collect()
    assert model.objective == pytest.approx(hinge_l1(np.array([r["v"] for r in rows]), np.array([r["label"] for r in rows]), model.weights, 0.1))
    hard = [(float(np.dot(model.weights, r["v"]) + model.intercept > 0.5), r["label"]) for r in test.select("v", "label").collect()]
    pos, neg = [s for s, y in hard if y], [s for s, y in hard if not y]
    wins = sum(1 if p > n else 0.5 if p == n else 0 for p in pos for n in neg)
    assert JOBS["ml_svm_l1"](spark, sf_dir).first()["auc"] == pytest.approx(wins / len(pos) / len(neg))


def test_l1_machine_against_a_plain_loop_and_the_older_trainer(spark):
    """Two telling columns among eight of noise: an objective no worse than that of many plain steps and of the older
    trainer, the noise exactly zero, the same for any partitions."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.mllib.classification import SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint

    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (400, 10))
    y = (2 * x[:, 0] - x[:, 1] + 0.5 * rng.normal(0, 1, 400) > 0).astype(float)
    df = spark.createDataFrame([(float(a), b.tolist()) for a, b in zip(y, x)] + [(None, x[0].tolist())], "label double, v array<double>")
    df = df.withColumn("features", array_to_vector("v"))
    model = fit_l1(df.repartition(5), reg=0.1)
    w, best = np.zeros(10), np.inf
    sign = np.where(y > 0, 1, -1)
    for t in range(1, 20_001):  # subgradient steps with the soft threshold
        short = sign * (x @ w) < 1
        w = soft(w + 0.5 / np.sqrt(t) * (sign[short, None] * x[short]).sum(axis=0) / 400, 0.1 * 0.5 / np.sqrt(t))
        best = min(best, hinge_l1(x, y, w, 0.1))
    assert model.objective <= 1.01 * best and model.objective == pytest.approx(hinge_l1(x, y, model.weights, 0.1))
    older = SVMWithSGD.train(spark.sparkContext.parallelize([LabeledPoint(a, b) for a, b in zip(y, x)]), 200, regParam=0.1, regType="l1")
    assert model.objective <= 1.01 * hinge_l1(x, y, older.weights.toArray(), 0.1)
    assert (model.weights[2:] == 0).sum() >= 6 and model.weights[0] > 0 > model.weights[1]
    assert np.allclose(fit_l1(df.coalesce(1), reg=0.1).weights, model.weights, atol=1e-3)
    with pytest.raises(ValueError):
        fit_l1(df.filter("label > 5"), reg=0.1)


def test_elastic_net_summary(spark, sf_dir):
    rows = JOBS["ml_elasticnet_residuals"](spark, sf_dir)
    row = rows.agg(F.sqrt(F.avg(F.pow("residual", F.lit(2.0)))).alias("rmse"), F.max("rmse").alias("theirs"),
                   F.max("iterations").alias("iterations")).first()
    assert row["rmse"] == pytest.approx(row["theirs"]) and row["iterations"] <= 11


def test_clusters_are_the_nearest_centres(spark, sf_dir):
    rows = ml_jobs.points(spark, sf_dir)
    model = ml.fit_kmeans(rows, 2)
    centers = np.array(model.clusterCenters())
    for r in model.transform(rows).select("v", "prediction").collect():
        assert np.argmin(((centers - np.array(r["v"])) ** 2).sum(axis=1)) == r["prediction"]


def test_every_text_has_a_cluster(spark, sf_dir):
    sizes = JOBS["ml_text_cluster_sizes"](spark, sf_dir).agg(F.sum("n")).first()[0]
    assert sizes == JOBS["ml_text_clusters"](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_synonyms_are_the_nearest_vectors(spark, sf_dir):
    found = JOBS["ml_word2vec_synonyms"](spark, sf_dir)
    vectors = {r["word"]: np.array(r["v"]) for r in ml_jobs.vectors_of_words(spark, sf_dir).collect()}
    names = sorted(vectors)
    unit = np.array([vectors[w] / np.linalg.norm(vectors[w]) for w in names])
    for at in (0, len(names) // 2, len(names) - 1):
        scores = unit @ unit[at]
        scores[at] = -2
        ours = found.filter(F.col("word") == names[at]).orderBy("place").collect()
        assert [r["similarity"] for r in ours] == pytest.approx(np.sort(scores)[::-1][:5].tolist(), abs=1e-9)


def test_grid_results(spark, sf_dir):
    """One setting of each grid fitted and measured again, apart from the grid."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
    from pyspark.ml.regression import LinearRegression

    cv = {(r["buckets"], r["reg"]): r["auc"] for r in JOBS["ml_cv_grid_metrics"](spark, sf_dir).collect()}
    assert set(cv) == {(b, r) for b in (10, 100, 1000) for r in (0.1, 0.01)}
    rows = ml_jobs.fold_rows(spark, sf_dir)
    areas = []
    for fold in (0, 1):
        model = ml.text_classifier(100, reg=0.1).fit(rows.filter(F.col("fold") != fold))
        areas.append(BinaryClassificationEvaluator().evaluate(model.transform(rows.filter(F.col("fold") == fold))))
    assert cv[100, 0.1] == pytest.approx(np.mean(areas), abs=1e-6)
    tvs = {(r["reg"], r["intercept"], r["mix"]): r["rmse"] for r in JOBS["ml_tvs_grid_metrics"](spark, sf_dir).collect()}
    assert len(tvs) == 12
    # the split of the grid is Spark's own: seeded numbers below the ratio train
    drawn = ml_jobs.sales_features(spark, sf_dir).select("features", "label", F.rand(1).alias("r"))
    model = LinearRegression(maxIter=10, regParam=0.1, elasticNetParam=0.5, fitIntercept=True).fit(drawn.filter("r < 0.8"))
    scored = model.transform(drawn.filter("r >= 0.8"))
    assert tvs[0.1, True, 0.5] == pytest.approx(RegressionEvaluator().evaluate(scored), rel=1e-6)


def test_explicit_factors_give_the_error(spark, sf_dir):
    """The job's error from the products of the factors, row by row."""
    rows = reco_jobs.ratings(spark, sf_dir)
    model = ml.fit_explicit(rows, iterations=5)
    users = {r["id"]: np.array(r["features"], np.float32) for r in model.userFactors.collect()}
    items = {r["id"]: np.array(r["features"], np.float32) for r in model.itemFactors.collect()}
    errors = [(r["rating"] - float(users[r["user"]] @ items[r["item"]])) ** 2 for r in rows.collect()]
    row = JOBS["ml_als_explicit_mse"](spark, sf_dir).first()
    assert row["n"] == len(errors) and row["mse"] == pytest.approx(np.mean(errors), rel=1e-3)


def test_recommendations(spark, sf_dir):
    names = {r["id"]: r["name"] for r in reco_jobs.artists(spark, sf_dir).collect()}
    best = JOBS["reco_user_topn"](spark, sf_dir).collect()
    by_user = {}
    for r in sorted(best, key=lambda r: (r["user"], r["place"])):
        by_user.setdefault(r["user"], []).append(r)
        assert r["name"] == names.get(r["item"])
    for rows in by_user.values():
        assert [r["place"] for r in rows] == list(range(1, len(rows) + 1))
        assert [r["score"] for r in rows] == sorted((r["score"] for r in rows), reverse=True)


def test_a_users_score_is_the_product_of_factors(spark, sf_dir):
    model = reco_jobs.model_of(spark, sf_dir)
    users = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    items = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    user = min(users)
    got = reco_ops.recommend(model, spark.createDataFrame([(user,)], "user int"), 3).orderBy("place").collect()
    want = sorted((float(users[user] @ v) for v in items.values()), reverse=True)[:3]
    assert [r["score"] for r in got] == pytest.approx(want, abs=1e-4)


def test_similar_items_leave_out_the_item(spark, sf_dir):
    model = reco_jobs.model_of(spark, sf_dir)
    item = model.itemFactors.agg(F.min("id")).first()[0]
    got = reco_ops.similar_items(model, item, 5).collect()
    assert item not in [r["item"] for r in got] and len(got) == 5
    assert [r["similarity"] for r in got] == sorted((r["similarity"] for r in got), reverse=True)


def test_item_users_and_batch_users(spark, sf_dir):
    assert JOBS["reco_item_users"](spark, sf_dir).groupBy("item").count().agg(F.max("count")).first()[0] <= 5
    rows = JOBS["reco_batch_users"](spark, sf_dir).collect()
    assert all(len(r["items"].split(", ")) == 5 for r in rows)


def test_personal_ranking_gives_the_area_of_the_factor_products(spark, sf_dir):
    """The mean area computed again from the products of the factors."""
    model = reco_jobs.model_of(spark, sf_dir)
    users = {r["id"]: np.array(r["features"], np.float32) for r in model.userFactors.collect()}
    items = {r["id"]: np.array(r["features"], np.float32) for r in model.itemFactors.collect()}
    by_user = {}
    for r in reco_jobs.auc_pairs(spark, sf_dir).collect():
        if r["user"] in users and r["item"] in items:
            by_user.setdefault(r["user"], ([], []))[r["label"]].append(float(users[r["user"]] @ items[r["item"]]))
    areas = [np.mean([p > n for p in pos for n in neg]) for neg, pos in by_user.values() if pos and neg]
    row = JOBS["reco_auc_als"](spark, sf_dir).first()
    assert row["users"] == len(areas) and row["auc"] == pytest.approx(np.mean(areas), abs=2e-3)
