"""Ordered operators with a key that holds a third of the rows: against brute force, and what their plans read."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heronlake.functions.hashing import PRIME, ROUNDS
from heronlake.operators import metrics, ml
from heronlake.operators import reco as reco_ops
from heronlake.operators.ordering import concat_by, moving_avg, positions, sum_below
from heronlake.operators.vectors import nearest_all

def mixed(value, seed):
    x = value % PRIME
    for a, b, c in ROUNDS:
        x = (x * x % PRIME + x * a + seed % PRIME * b + c) % PRIME
    return x


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = [("hot" if i % 3 == 0 else f"k{rng.randrange(12)}", rng.randrange(90), i, rng.random()) for i in range(600)]
    data += [(None, 5, 1000 + i, 0.5) for i in range(7)]
    return data, spark.createDataFrame(data, "key string, day int, id int, x double")


def by_key(data):
    groups = {}
    for r in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


def test_positions(rows):
    data, df = rows
    pieces = F.struct("day", F.expr("id div 50"))
    got = {r["id"]: r["pos"] for r in positions(df, ["key"], ["day", "id"], pieces).collect()}
    assert got == {r[2]: i for group in by_key(data).values() for i, r in enumerate(group)}


@pytest.mark.parametrize("lo,hi,chunk", [(-1, 1, 7), (-3, 0, 2), (0, 4, 3)])
def test_moving_avg(rows, lo, hi, chunk):
    data, df = rows
    out = moving_avg(df, ["key"], ["day", "id"], "x", F.expr("day div 4"), lo, hi, chunk=chunk)
    got = {r["id"]: r["moving_avg"] for r in out.collect()}
    for group in by_key(data).values():
        for i, r in enumerate(group):
            frame = [g[3] for g in group[max(0, i + lo):i + hi + 1]]
            assert got[r[2]] == pytest.approx(sum(frame) / len(frame))
    assert len(got) == len(data)


def test_concat(rows):
    data, df = rows
    out = concat_by(df.withColumn("s", F.col("id").cast("string")), ["key"], "s", ["day", "id"],
                    F.expr("day div 4"), chunk=10).collect()
    assert max(r["n"] for r in out) <= 10
    for key, group in by_key(data).items():
        chunks = sorted((r["chunk_no"], r["joined"]) for r in out if r["key"] == key)
        assert "+".join(c for _, c in chunks) == "+".join(str(g[2]) for g in group)


def test_sum_below(spark):
    rng = random.Random(3)
    data = [(k, float(v), rng.randrange(5)) for k in "ab" for v in rng.sample(range(-40, 40), 30)]
    df = spark.createDataFrame(data, "key string, score double, n int")
    got = {(r["key"], r["score"]): r["below"] for r in sum_below(
        df, ["key"], "score", "n", F.floor("score")).collect()}
    assert got == {(k, s): sum(n for k2, s2, n in data if k2 == k and s2 < s) for k, s, _ in data}


@pytest.mark.parametrize("ties", [0.0, 0.5])
def test_auc_equals_all_pairs(spark, ties):
    rng = random.Random(11)
    data = [(rng.choice("abc"), round(rng.random() * 2 - 0.5, 1), rng.randrange(2)) for _ in range(200)] + [("d", 1.0, 1)]
    df = spark.createDataFrame(data, "user string, score double, label int")
    got = {r["user"]: r["auc"] for r in metrics.auc(df, ["user"], ties=ties).collect()}
    for user in "abc":
        pos = [s for u, s, l in data if u == user and l]
        neg = [s for u, s, l in data if u == user and not l]
        wins = sum(1 if p > n else ties if p == n else 0 for p in pos for n in neg)
        assert got[user] == pytest.approx(wins / len(pos) / len(neg))
    assert "d" not in got


def test_negatives(spark):
    rng = random.Random(5)
    items = list(range(10, 30))
    owned = {1: items, 2: items[:-1], 3: items[3:9] + items[-2:], 4: [items[0]], 5: rng.sample(items, 10)}
    pairs = [(u, i) for u, own in owned.items() for i in own]
    got = reco_ops.negatives(spark.createDataFrame(pairs + pairs[:4], "user int, item int"),
                             spark.createDataFrame([(i,) for i in items], "item int")).collect()
    size = len(items)
    want = []
    for u, own in owned.items():
        for i in own:
            at = mixed(mixed(u, 1) + items.index(i), 1) % size
            tries = [items[(at + step) % size] for step in range(size)]
            want += [(u, t) for t in tries if t not in own][:1]
    assert sorted(tuple(r) for r in got) == sorted(want)


@pytest.mark.parametrize("block_rows", [1 << 13, 17])
def test_nearest_all(spark, block_rows):
    import numpy as np

    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(60, 8))
    df = spark.createDataFrame([(f"w{i}", [float(x) for x in v]) for i, v in enumerate(vectors)],
                               "word string, v array<double>")
    got = nearest_all(df, 3, dim=8, block_rows=block_rows).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -2)
    want = {(f"w{i}", f"w{j}") for i in range(60) for j in np.argsort(-sims[i])[:3]}
    assert {(r["word"], r["neighbour"]) for r in got} == want


def test_nearest_all_by_stretches_keeps_ties(spark, monkeypatch):
    """Scores are cut at a row's k-th so far; of equal ones the smaller id stays, wherever its stretch lies."""
    from heronlake.operators import vectors

    axes = [[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0]]
    df = spark.createDataFrame([(i, axes[i % 3]) for i in range(40)], "word long, v array<double>")
    monkeypatch.setattr(vectors, "STRETCH", 7)
    got = {(r["word"], r["place"]): r["neighbour"] for r in nearest_all(df, 4, dim=2, block_rows=16).collect()}
    assert got == {(i, p + 1): j for i in range(40) for p, j in enumerate([j for j in range(i % 3, 40, 3) if j != i][:4])}


def test_ordered_operators_read_their_input_once(spark, sf_dir):
    """With a key that holds a third of the rows: the input is stored, and what comes after reads only that."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).alias("k"), "o_orderdate", "o_orderkey", "o_totalprice")
    day = F.to_date("o_orderdate")
    for out in (positions(orders, ["k"], ["o_orderdate", "o_orderkey"], day),
                moving_avg(orders, ["k"], ["o_orderdate", "o_orderkey"], "o_totalprice", day)):
        assert not [f for f in out.inputFiles() if "orders.parquet" in f]
        rows = out._jdf.queryExecution().executedPlan().toString().split("Window")[0]
        assert "hashpartitioning(k" not in rows or "_bucket" in rows


def test_scores_in_a_narrow_range_are_spread(spark):
    """The area under ROC of scores inside [0.5, 0.5005): every range has its share, and the value is right."""
    rng = random.Random(3)
    data = [(0.5 + rng.random() * 0.0005, rng.randrange(2)) for _ in range(4_000)]
    df = spark.createDataFrame(data, "score double, label int")
    ranges = df.select("score").repartitionByRange(8, "score").groupBy(F.spark_partition_id()).count().collect()
    assert len(ranges) > 1 and max(r["count"] for r in ranges) < 2 * 4_000 / len(ranges)
    ranked = sorted(data)
    wins, below = 0, 0
    for _, label in ranked:
        wins += below if label else 0
        below += not label
    assert metrics.auc(df).first()["auc"] == pytest.approx(wins / below / (len(data) - below))


@pytest.mark.parametrize("ids", [range(0, 400_000, 100), range(10**18, 10**18 + 4_000), range(4_000)])
def test_splits_are_even_for_any_ids(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    part = lambda seed: {r["id"] for r in ml.hash_split(df, "id", 0.6, seed).filter("part = 'train'").collect()}
    first, second = part(0), part(1)
    assert abs(len(first) - 2_400) < 160 and abs(len(second) - 2_400) < 160
    assert abs(len(first & second) - 1_440) < 160
    pairs = df.select((F.col("id") % 1_000).cast("int").alias("user"), F.col("id").alias("item"))
    assert abs(reco_ops.split(pairs, 0.9).filter("part = 'train'").count() - 3_600) < 100


def test_models_do_not_depend_on_the_input_s_partitions(spark, sf_dir):
    """What differs between clusters is the number of partitions of the input; the fits must not see it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    plays = spark.createDataFrame([(i % 40, i * 7 % 60, float(1 + i % 5)) for i in range(900)], "user int, item int, rating double")
    found = []
    for n in (2, 7):
        clusters = ml.bigram_cluster_stages(5, key="doc_id").fit(docs.repartition(n)).transform(docs)
        factors = reco_ops.train_implicit(plays.repartition(n), 3, 2).itemFactors.orderBy("id").collect()
        found.append(([r["cluster"] for r in clusters.orderBy("doc_id").collect()], [x for f in factors for x in f["features"]]))
    assert found[0][0] == found[1][0]
    assert found[0][1] == pytest.approx(found[1][1], abs=1e-3)


def test_distinct_counts_do_not_expand(spark, sf_dir):
    from heronlake.operators.relational import column_profile

    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    assert "Expand" not in column_profile(nation)._jdf.queryExecution().executedPlan().toString()


def test_a_value_of_many_lines_is_no_log_record(spark):
    from heronlake.operators.logs import parse_access_log

    df = spark.createDataFrame([("a\nb\nc\nd\ne\nf\ng\n200\n5",)], "value string")
    assert parse_access_log(df).count() == 0


def test_one_name_per_artist(spark):
    lines = spark.createDataFrame([("1\tA",), ("1\tB",), ("2\tC",)], "value string")
    assert sorted(tuple(r) for r in reco_ops.artists(lines).collect()) == [(1, "B"), (2, "C")]


def test_nearest_all_moves_no_matrices_for_pairs(spark):
    """Each task reads the two stored parts it multiplies; a shuffle of all pairs grew with the square of the blocks."""
    rng = np.random.default_rng(2)
    ids = [int(i) % 150 for i in rng.permutation(300)]  # repeated ids are no neighbours of themselves
    vectors = rng.integers(-3, 4, (300, 3)).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "id long, v array<double>").repartition(3)
    found = nearest_all(df, 4, "id", dim=3, block_rows=40)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and plan.count("Exchange") == 1
    got = {(r["id"], r["place"]): r["similarity"] for r in found.collect()}
    unit = [v / np.linalg.norm(v) for v in vectors if v.any()]
    kept = [i for i, v in zip(ids, vectors) if v.any()]
    for one in sorted(set(kept)):
        scores = sorted((float(u @ unit[m]) for m, mine in enumerate(kept) if mine == one for u, i in zip(unit, kept) if i != one), reverse=True)
        assert [got[one, place] for place in range(1, 5)] == pytest.approx(scores[:4])
