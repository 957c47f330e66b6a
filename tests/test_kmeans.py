"""K-means: the same centres for any partitioning, the start, exact sums and odd inputs."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from heronlake.operators import kmeans, ml
from heronlake.session import fresh_dir


def frame(spark, x, parts=3):
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    return rows.repartition(parts).withColumn("features", array_to_vector("v"))


def groups(count=6, each=80, size=5, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 30, (count, size))
    return np.concatenate([m + rng.normal(0, 1, (each, size)) for m in middles]), middles


def cost(x, centers):
    return ((x[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_same_centres_for_any_partitioning(spark):
    x = np.random.default_rng(5).normal(0, 1, (500, 4))
    found = [kmeans.fit_centers(frame(spark, x, n), 7, 5, key="id").tolist() for n in (1, 4, 13)]
    assert found[0] == found[1] == found[2]


def test_far_groups_are_found_and_centres_are_means(spark):
    x, middles = groups()
    centers = kmeans.fit_centers(frame(spark, x), 6, key="id")
    label = ((x[:, None] - middles[None]) ** 2).sum(axis=2).argmin(axis=1)
    means = np.array(sorted(x[label == g].mean(axis=0).tolist() for g in range(6)))
    assert np.allclose(np.array(sorted(centers.tolist())), means, atol=1e-9)


def test_cost_is_near_that_of_the_other_trainer(spark):
    x = np.random.default_rng(9).normal(0, 1, (600, 3))
    df = frame(spark, x)
    theirs = min(cost(x, np.array(KMeans(k=8, seed=s, maxIter=30).fit(df).clusterCenters())) for s in range(3))
    assert cost(x, kmeans.fit_centers(df, 8, 30, key="id")) < 1.1 * theirs


def test_a_pass_against_a_plain_loop(spark):
    x, _ = groups(4, 30)
    rows = kmeans._Rows(frame(spark, x, 5), "features", "id", 1)
    centers = x[[0, 31, 61, 91]]
    counts, totals = rows.sums(centers)
    best = [min(range(4), key=lambda c: ((p - centers[c]) ** 2).sum()) for p in x]
    for c in range(4):
        mine = [p for p, b in zip(x, best) if b == c]
        assert counts[c] == len(mine)
        assert np.allclose(np.ldexp(totals[c].astype(float), -rows.bits), sum(mine), atol=1e-9)


def test_draws_follow_the_costs(spark):
    """A tenth of the rows holds nearly all of the cost, so nearly all draws fall there."""
    x = np.concatenate([np.random.default_rng(1).normal(0, 0.01, (900, 2)), np.random.default_rng(2).normal(500, 50, (100, 2))])
    rows = kmeans._Rows(frame(spark, x), "features", "id", 1)
    drawn = rows.drawn(np.zeros((1, 2)), 0, 40)
    assert len(drawn) == 40 and (drawn[:, 0] > 100).all()
    assert len(np.unique(drawn, axis=0)) == 40


@pytest.mark.parametrize("ties", [False, True])
def test_nearest_against_a_loop(ties):
    rng = np.random.default_rng(4)
    x = rng.integers(-3, 4, (300, 3)).astype(float) if ties else rng.normal(0, 1, (300, 3)) + 1e6
    centers = x[rng.choice(300, 12, replace=False)]
    best, costs = kmeans.nearest(x, centers)
    for p, b, d in zip(x, best, costs):
        each = [((p - c) ** 2).sum() for c in centers]
        assert b == int(np.argmin(each)) and d == each[b]


def test_scaled_sums_stay_within_a_word():
    for largest, rows in ((1.0, 10**12), (1e9, 10**6), (0.75, 1), (3e-300, 7), (5e15, 10**10)):
        bits = kmeans.scale_bits(largest, rows)
        assert int(np.ldexp(largest, bits)) * rows + rows < 1 << 63
    assert kmeans.scale_bits(0.0, 5) == 0


def test_many_copies_and_few_points(spark):
    """Two thirds of the rows are one point; with the id as key it does not use a round up."""
    x = np.concatenate([np.full((400, 2), 7.0), groups(3, 60, 2)[0]])
    centers = kmeans.fit_centers(frame(spark, x), 4, key="id")
    assert len(centers) == 4 and any(np.allclose(c, 7.0) for c in centers)
    few = np.array([[1.0, 2.0]] * 50 + [[3.0, 4.0]] * 50)
    assert sorted(kmeans.fit_centers(frame(spark, few), 5, key="id").tolist()) == [[1.0, 2.0], [3.0, 4.0]]
    assert sorted(kmeans.fit_centers(frame(spark, few), 2).tolist()) == [[1.0, 2.0], [3.0, 4.0]]


def test_rows_that_cannot_be_placed(spark):
    x, _ = groups(2, 20)
    df = frame(spark, x).select("id", "features")
    without = df.union(spark.createDataFrame([(999, None), (None, None)], df.schema))
    assert np.array_equal(kmeans.fit_centers(without, 2, key="id"), kmeans.fit_centers(df, 2, key="id"))
    nameless = df.withColumn("id", F.lit(None).cast("long"))
    assert np.array_equal(kmeans.fit_centers(nameless, 2, key="id"), kmeans.fit_centers(df, 2))
    with pytest.raises(ValueError, match="no rows"):
        kmeans.fit_centers(df.limit(0), 2)
    with pytest.raises(ValueError, match="not finite"):
        kmeans.fit_centers(frame(spark, np.array([[1.0, np.nan], [2.0, 3.0]])), 2)


def test_the_model_is_saved_and_scores(spark):
    x, _ = groups(3, 20)
    df = frame(spark, x)
    model = ml.fit_kmeans(df, 3, key="id")
    path = fresh_dir(spark, "kmeans-test")
    model.write().overwrite().save(path)
    again = KMeansModel.load(path)
    assert np.array_equal(np.array(again.clusterCenters()), np.array(model.clusterCenters()))
    scored = again.transform(df).groupBy("prediction").agg(F.count(F.lit(1)).alias("n")).collect()
    assert sorted(r["n"] for r in scored) == [20, 20, 20]


def test_batches_are_worked_on_in_pieces(monkeypatch):
    """No step sees more rows than a piece holds; all rows come, once and in order."""
    x, _ = groups()
    monkeypatch.setattr(kmeans, "PIECE", 100)
    batches = [kmeans.pa.RecordBatch.from_pydict({"v": x.tolist()})] * 2 + [kmeans.pa.RecordBatch.from_pydict({"v": [[0.0]]}).slice(0, 0)]
    cut = [kmeans.matrix(b.column(0)) for b in kmeans.pieces(iter(batches))]
    assert [len(c) for c in cut] == [100, 100, 100, 100, 80] * 2 and np.array_equal(np.concatenate(cut), np.concatenate([x, x]))
