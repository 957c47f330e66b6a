"""Factor models: the same numbers as Spark's ALS, with each rating moved once a side and nothing stored that is read once."""

import glob

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from heronlake import session
from heronlake.operators import factors, packed, reco
from heronlake.plans import ml as ml_jobs
from heronlake.plans import reco as jobs

CASES = [(None, 1), (None, 3), (1.0, 2), (40.0, 3)]


@pytest.fixture(scope="module")
def rows(spark):
    """Steps of ids, negative ids, one item that all have, repeated pairs, ratings of zero and below."""
    rng = np.random.default_rng(7)
    data = [(int(u) * 3 - 60, int(i) * 5 - 100, float(r)) for u, i, r in zip(
        rng.integers(0, 60, 900), rng.integers(0, 70, 900), rng.integers(-2, 9, 900))]
    data += [(u * 3 - 60, 7, 2.0) for u in range(60)] + data[:40] + [(5_000_000, 7, 1.0), (-60, 2_000_000_000, 3.0)]
    return spark.createDataFrame(data, "user int, item int, rating double").repartition(3).cache()


def by_id(df):
    return {r["id"]: np.array(r["features"]) for r in df.collect()}


@pytest.mark.parametrize("alpha,groups", CASES)
def test_fit_equals_als(spark, rows, alpha, groups):
    mine = factors.fit(rows, 4, 3, 0.05, alpha, 5, 9, groups)
    theirs = ALS(rank=4, maxIter=3, regParam=0.05, alpha=alpha or 1.0, implicitPrefs=alpha is not None, userCol="user", itemCol="item",
                 ratingCol="rating", numUserBlocks=5, numItemBlocks=5, seed=9, coldStartStrategy="drop").fit(rows)
    for got, want in ((mine.userFactors, theirs.userFactors), (mine.itemFactors, theirs.itemFactors)):
        assert got.dtypes == want.dtypes
        got, want = by_id(got), by_id(want)
        assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], 1e-3, 1e-4) for i in want)
    assert mine.rank == 4 and mine.getColdStartStrategy() == "drop"


def test_scores_equal_transform(spark, rows):
    """Unknown users and items are left out, repeated pairs and ratings stay."""
    model = factors.fit(rows, 4, 2, 0.05)
    more = rows.unionByName(spark.createDataFrame([(1, 7, 1.0), (-60, 8, 1.0), (-60, 7, 0.25)], rows.schema))
    want = model.transform(more).select("user", "item", "rating", "prediction").collect()
    got = factors.score(model, more)
    assert got.dtypes == [("user", "int"), ("item", "int"), ("rating", "double"), ("prediction", "float")]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want)) and len(want) == rows.count() + 1


def test_each_rating_moves_once_a_side(rows):
    """Spark's ALS moves the ratings three times, and each factor to every one of its blocks."""
    moved = factors._packed(rows, (packed.USERS, packed.ITEMS), 3).collect()
    n = rows.count()
    assert [sum(r[1] for p, r in moved if p // 3 == side) for side in (0, 1)] == [n, n]
    pieces = factors.grouped(rows, (packed.USERS, packed.ITEMS), 3)
    assert pieces.getNumPartitions() == 6
    assert sorted(p // 3 for p, r in pieces.collect() for _ in range(len(r[5]))) == [0] * n + [1] * n
    pieces.unpersist()


@pytest.mark.parametrize("column,value", [("user", "cast(null as int)"), ("item", "cast(null as int)"), ("rating", "cast(null as double)"),
                                          ("rating", "cast('NaN' as double)"), ("rating", "cast('Infinity' as double)")])
def test_bad_rows_are_refused(rows, column, value):
    """As Spark's ALS does."""
    with pytest.raises(Exception, match="null or not finite"):
        factors.fit(rows.withColumn(column, F.expr(value)), 2, 1, 0.1)


def test_long_lists_in_slices(monkeypatch):
    """A list longer than what is multiplied at once gives the same factors."""
    rng = np.random.default_rng(1)
    counts, known = np.array([50, 3, 50, 1, 7]), rng.normal(size=(20, 3)).astype(np.float32)
    which, ratings = rng.integers(0, 20, 111), rng.integers(-1, 5, 111).astype(np.float32)
    for alpha in (None, 2.0):
        every = known.T.astype(float) @ known if alpha else np.zeros((3, 3))
        want = packed.solve(counts, known, which, ratings, 0.1, alpha, every)
        monkeypatch.setattr(packed, "AT_ONCE", 8)
        assert np.allclose(packed.solve(counts, known, which, ratings, 0.1, alpha, every), want, 1e-5, 1e-6)
        monkeypatch.undo()


@given(st.lists(st.integers(-(1 << 31), (1 << 31) - 1), max_size=50))
def test_squeezed_values_come_back(values):
    array = np.array(values, np.int32)
    assert packed.loosen(packed.squeeze(array), len(array), np.int32).tolist() == values


def test_model_stores_no_parts(spark, sf_dir):
    """The fit reads the training part once, so it is not written for it, and the lines are stored compressed."""
    kept = dict(session._written)
    session._written.clear()
    try:
        jobs.model_of(spark, sf_dir)
        assert sorted(key[2] for key in session._written) == ["als", "plays"]
        plays = next(path for key, path in session._written.items() if key[2] == "plays")
        assert glob.glob(f"{plays}/*.txt.gz") and not glob.glob(f"{plays}/*.txt")
    finally:
        session._written.update(kept)


def test_grid_moves_ratings_and_pairs_once(monkeypatch, spark, rows):
    """All settings share the ratings, those of one rank their start, and the areas are those of fits for themselves."""
    calls = []
    for name in ("grouped", "pairs_of", "start"):
        own = getattr(factors, name)
        monkeypatch.setattr(factors, name, lambda *a, _name=name, _own=own: (calls.append(_name), _own(*a))[1])
    some = rows.filter("rating > 0").withColumn("label", (F.col("rating") > 4).cast("int")).drop("rating")
    pairs = some.unionByName(spark.createDataFrame([(1, 7, 1), (-60, 8, 0)], "user int, item int, label int"))
    found = reco.grid(rows, pairs, (2, 3), (0.1, 0.01), (1.0,), iterations=2)
    assert sorted(calls) == ["grouped", "pairs_of", "start", "start"]
    for rank, reg, alpha, area in found:
        model = reco.train_implicit(rows, rank, 2, reg, alpha)
        assert area == pytest.approx(reco.mean_auc(pairs, reco.predict_model(model)).first()["auc"], abs=1e-12)


def test_no_step_is_solved_twice(monkeypatch, spark, rows):
    solved, own = spark.sparkContext.accumulator(0), factors._half
    monkeypatch.setattr(factors, "_half", lambda *a: own(*a).map(lambda c: (solved.add(c[2]), c)[1]))
    model = factors.fit(rows, 2, 2, 0.1, groups=1)
    assert solved.value == 2 * (model.userFactors.count() + model.itemFactors.count())


def test_explicit_error_is_that_of_ten_iterations(spark, sf_dir):
    """The job fits as many iterations as the example it follows, not half of them."""
    rows = jobs.ratings(spark, sf_dir)
    model = factors.fit(rows, 10, 10, 0.01, seed=1)
    users, items = by_id(model.userFactors), by_id(model.itemFactors)
    errors = [(r["rating"] - float(users[r["user"]] @ items[r["item"]])) ** 2 for r in rows.collect()]
    row = ml_jobs.ml_als_explicit_mse(spark, sf_dir).first()
    assert row["n"] == len(errors) and row["mse"] == pytest.approx(np.mean(errors), rel=1e-3)
