"""Splits, negatives, exact search and the recommender's grid, each against a plain recomputation."""

import time

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from heronlake.functions.hashing import PRIME, ROUNDS, mixed
from heronlake.operators import reco
from heronlake.operators.search import best_of, inner_top
from heronlake.plans import reco as jobs


def plain_mixed(value, seed=0):
    x = value % PRIME
    for a, b, c in ROUNDS:
        x = ((x * x) % PRIME + x * a + (seed % PRIME) * b + c) % PRIME
    return x


def test_hash_against_a_plain_one(spark):
    values = [0, 1, -1, -(1 << 62), (1 << 62) + 12345, PRIME, PRIME - 1, None]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", mixed(F.col("v"), 77).alias("h")).collect()
    assert [r["h"] for r in rows] == [None if v is None else plain_mixed(v, 77) for v in values]


def test_filtered_split_holds_its_hash_once(spark):
    """A filter on the part must not write the hash out again for every use of its value."""
    rows = spark.range(100).select(F.col("id").alias("user"), (F.col("id") % 7).alias("item"))
    plan = reco.split(rows, 0.9).filter("part = 'valid'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(str(ROUNDS[0][0])) <= 4


@given(st.integers(1, 40), st.data())
def test_next_free_place(size, data):
    owned = sorted(data.draw(st.sets(st.integers(0, size - 1))))
    draws = data.draw(st.lists(st.integers(0, size - 1), max_size=20))
    got = reco.next_free(np.array(owned, np.int64), np.array(draws, np.int64), size).tolist()
    assert got == [next((p for p in range(d, size) if p not in owned), -1) for d in draws]


@given(st.lists(st.tuples(st.integers(1, 12), st.data()), max_size=6))
def test_next_free_places_of_many_lists(lists):
    """All lists are searched at once, each gets what it gets by itself; some own nothing, some all, some draw nothing."""
    owned, draws, group, at, want = [], [], [], [0], []
    for g, (size, data) in enumerate(lists):
        mine = sorted(data.draw(st.sets(st.integers(0, size - 1))))
        some = data.draw(st.lists(st.integers(0, size - 1), max_size=5))
        owned, draws, group, at = owned + mine, draws + some, group + [g] * len(some), [*at, len(owned) + len(mine)]
        want += [next((p for p in range(d, size) if p not in mine), -1) for d in some]
    got = reco.next_free_of(*[np.array(x, np.int64) for x in (owned, at, draws, group, [size for size, _ in lists])])
    assert got.tolist() == want


@pytest.mark.parametrize("places", [reco.PLACES, 4, 16])
def test_negatives_against_a_walk(spark, places):
    """Every draw goes on to the user's next free item, over the end of the list and of stretches; one user owns all, one
    nearly all, one a full stretch."""
    items = list(range(3, 100, 2))
    pairs = [(1, i) for i in items] + [(2, i) for i in items if i != 51] + [(3, i) for i in items[:32]] + [(4, 5), (4, 5), (4, 97)]
    positives = spark.createDataFrame(pairs, "user int, item int").repartition(4)
    frame = spark.createDataFrame([(i,) for i in items], "item int")
    got = sorted(tuple(r) for r in reco.negatives(positives, frame, places=places).collect())
    want = []
    for user, item in set(pairs):
        own = {i for u, i in pairs if u == user}
        if len(own) == len(items):
            continue
        place = plain_mixed(plain_mixed(user, 1) + items.index(item), 1) % len(items)
        while items[place] in own:
            place = (place + 1) % len(items)
        want.append((user, items[place]))
    assert got == sorted(want)


def plain_top(queries, items, k):
    out = []
    for q, v in queries:
        scores = sorted(((-float(np.dot(v, w)), i) for i, w in items))
        out += [(q, place + 1, i, -s) for place, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("rows,query_rows", [(4_096, 1_024), (16, 7)])
def test_inner_products_against_the_full_product(spark, rows, query_rows):
    """Whole numbers, so that ties are exact; zero and opposite vectors, repeated ones, and norms that differ widely."""
    rng = np.random.default_rng(3)
    items = [(int(i), (rng.integers(-4, 5, 5) * (20 if i % 40 == 0 else 1)).astype(float).tolist()) for i in rng.permutation(300)]
    items += [(1_000, [0.0] * 5), (1_001, items[0][1])]
    queries = [(int(i), rng.integers(-4, 5, 5).astype(float).tolist()) for i in range(30)] + [(90, [0.0] * 5)]
    frame = lambda data: spark.createDataFrame([*data, (5_000, None)], "id long, v array<double>").repartition(3)
    found = inner_top(frame(queries), frame(items), 6, rows, query_rows)
    assert sorted(tuple(r) for r in found.result.collect()) == plain_top(queries, items, 6)
    assert found.pairs == -(-len(items) // rows) * -(-len(queries) // query_rows)
    few = inner_top(frame(queries), frame(items[:4]), 6, rows, query_rows)
    assert sorted(tuple(r) for r in few.result.collect()) == plain_top(queries, items[:4], 6)
    assert inner_top(frame(queries), frame([]).filter("v is not null"), 6).result.count() == 0
    assert inner_top(frame([]), frame(items), 6).result.count() == 0


def test_blocks_that_cannot_win_are_left_out(spark):
    """Norms that fall off: most matrices are never multiplied, and the result is the same."""
    rng = np.random.default_rng(5)
    items = [(i, (rng.normal(0, 1, 8) / (1 + i / 20)).tolist()) for i in range(2_000)]
    queries = [(i, rng.normal(0, 1, 8).tolist()) for i in range(40)]
    found = inner_top(spark.createDataFrame(queries, "id int, v array<double>"), spark.createDataFrame(items, "id int, v array<double>"),
                      5, rows=64, query_rows=40)
    got = [(q, place, i) for q, place, i, _ in sorted(tuple(r) for r in found.result.collect())]
    assert got == [(q, place, i) for q, place, i, _ in plain_top(queries, items, 5)]
    assert found.skipped > 0.7


@given(st.lists(st.lists(st.integers(-3, 3), min_size=9, max_size=9), min_size=1, max_size=5), st.integers(1, 9))
def test_best_of_a_line(lines, k):
    got = best_of(np.array(lines, float), np.arange(9), k)
    assert got.tolist() == [sorted(range(9), key=lambda i: (-line[i], i))[:k] for line in lines]


def test_recommendations_against_all_products(spark, sf_dir):
    """Ten best items of some users, from the factors that the preview shows as well."""
    model = jobs.model_of(spark, sf_dir)
    users = {r["id"]: np.array(r["features"], float) for r in model.userFactors.collect()}
    items = {r["id"]: np.array(r["features"], float) for r in model.itemFactors.collect()}
    some = sorted(users)[:7]
    got = reco.recommend(model, spark.createDataFrame([(u,) for u in some], "user int"), 10).collect()
    for user in some:
        mine = [(r["item"], r["score"]) for r in sorted(got, key=lambda r: r["place"]) if r["user"] == user]
        want = sorted(items, key=lambda i: (-float(users[user] @ items[i]), i))[:10]
        assert [i for i, _ in mine] == want and all(abs(s - users[user] @ items[i]) < 1e-9 for i, s in mine)
    preview = jobs.reco_factor_preview(spark, sf_dir).collect()
    assert len(preview) == 20
    for r in preview:
        assert np.allclose(r["features"], (users if r["kind"] == "user" else items)[r["id"]])


def test_grid_areas_recomputed(spark, sf_dir):
    """Each setting's area from its own fit and a loop over users, best first."""
    train = jobs.train_valid(spark, sf_dir)[0].cache()
    pairs = jobs.auc_pairs(spark, sf_dir)
    found = reco.grid(train, pairs, (4,), (1.0, 0.01), (1.0,), iterations=2)
    assert [f[3] for f in found] == sorted((f[3] for f in found), reverse=True) and len(found) == 2
    rank, reg, alpha, area = found[0]
    scored = reco.predict_model(reco.train_implicit(train, rank, 2, reg, alpha))(pairs).collect()
    by_user = {}
    for r in scored:
        by_user.setdefault(r["user"], ([], []))[r["label"]].append(r["prediction"])
    areas = [np.mean([p > n for p in pos for n in neg]) for neg, pos in by_user.values() if pos and neg]
    assert abs(area - np.mean(areas)) < 1e-9


def test_grid_lets_its_fits_go(spark):
    """After a grid at most its last fit is kept, so the disk does not grow with the number of settings."""
    def kept() -> int:
        return sum(r.name() in ("userFactors", "itemFactors") for r in spark.sparkContext._jsc.getPersistentRDDs().values())

    rows = spark.range(400).select((F.col("id") % 20).cast("int").alias("user"), (F.col("id") * 7 % 31).cast("int").alias("item"))
    train, before = rows.withColumn("rating", F.lit(1.0)), kept()
    reco.grid(train, rows.withColumn("label", F.col("item") % 2), (2,), (1.0, 0.1, 0.01, 0.001), (1.0,), iterations=1)
    end = time.time() + 30
    while kept() > before + 2 and time.time() < end:  # Spark's cleaner runs beside the program
        time.sleep(0.2)
    assert kept() <= before + 2
