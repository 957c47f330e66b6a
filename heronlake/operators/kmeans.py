"""K-means whose start and centres do not depend on how the rows are partitioned.

Seeding in oversampled rounds: in every round each row gets the time -log(u) / cost, where u comes from a hash of the row,
the seed and the round, and cost is its squared distance to the candidates so far; the `2 * k` rows with the least
times join the candidates (a draw without replacement by cost, as a top-k without a shuffle). Every candidate then weighs
as many rows as it is nearest to, and k of them are chosen and moved on the driver, which holds 2 * k * rounds + 1 candidates.
Passes then send, per task and cluster, a count and sums of whole numbers: values are scaled by a power of two that
keeps the sum of all rows within 63 bits, so no order of adding changes a centre. Sums meet by cluster and component.

Rows without features take no part. Fewer distinct points than k give as many centres as there are points. A cluster that loses
all its rows keeps its centre. Of equal costs the lower number wins. `key` names what tells equal points apart (an id);
rows without one draw by their values, so equal ones draw the same number, and a round may be spent on copies of one point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.session import fresh_dir

ROUNDS = 2
#: Bits of the sums of a cluster; one of 64 is the sign, one is left over for rounding.
SUM_BITS = 62


#: Rows of an Arrow batch that are worked on at a time: a batch of long vectors is large, and each step makes copies of it.
PIECE = 1_024
#: The fields in which Spark stores a vector.
STORED = "features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            yield batch.slice(at, PIECE)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def exact_costs(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, each summed by itself, so that it does not depend on the rows around it."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centers], axis=1)


def dense(column: pa.StructArray, size: int) -> np.ndarray:
    """Rows of a column of vectors as Spark stores them, sparse ones (type 0) and dense ones."""
    x = np.zeros((len(column), size))
    kind, indices, values = (column.field(name) for name in ("type", "indices", "values"))
    sparse, lengths = kind.to_numpy() == 0, values.value_lengths().to_numpy()
    begin = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(begin, lengths)  # of a dense row's values
    place[np.repeat(sparse, lengths)] = indices.filter(pa.array(sparse)).flatten().to_numpy()
    x[np.repeat(np.arange(len(column)), lengths), place] = values.flatten().to_numpy()
    return x


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre and the squared distance to it."""
    best = nearest_of(x, centers)
    return best, ((x - centers[best]) ** 2).sum(axis=1)


def nearest_of(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Number of the nearest centre.

    A matrix product finds the centre; rows whose best two are within its rounding error are computed again one by one."""
    rows, norms = (x ** 2).sum(axis=1), (centers ** 2).sum(axis=1)
    rough = rows[:, None] - 2 * (x @ centers.T) + norms
    best = rough.argmin(axis=1)
    error = 1e-12 * (rows + norms.max())
    near = rough <= rough.min(axis=1)[:, None] + error[:, None]
    unsure = np.flatnonzero(near.sum(axis=1) > 1)
    for at in range(0, len(unsure), 1024):
        some = unsure[at:at + 1024]
        costs = np.where(near[some], exact_costs(x[some], centers), np.inf)
        best[some] = costs.argmin(axis=1)
    return best


def scale_bits(largest: float, rows: int) -> int:
    """The power of two by which values are scaled: the sum of `rows` values up to `largest` stays within SUM_BITS."""
    if largest == 0:
        return 0
    return SUM_BITS - int(np.frexp(largest)[1]) - max(rows, 1).bit_length()


class _Rows:
    """The rows (draw, v) and the passes over them. Vectors are stored as they come, so sparse ones stay small on disk."""

    def __init__(self, df: DataFrame, features: str, key: str | None, seed: int) -> None:
        path = fresh_dir(df.sparkSession, "points")
        df.select((F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"),
                  F.col(features).alias("features")).write.parquet(path)
        stored = df.sparkSession.read.parquet(path)
        # the same vectors as their stored fields: a pass gets a sparse one as it is
        self.stored = df.sparkSession.read.schema(STORED).parquet(path).filter("features IS NOT NULL")
        v = vector_to_array("features")
        draw = F.when(F.col("key").isNull(), F.xxhash64(F.lit(seed), v)).otherwise(F.xxhash64(F.lit(seed), "key"))
        self.rows = stored.filter("features IS NOT NULL").select(draw.alias("draw"), v.alias("v"))
        largest = F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")), F.lit(0.0))
        self.count, self.largest, least = self.rows.agg(F.count(F.lit(1)), F.max(largest), F.min(F.struct("draw", "v"))).first()
        if not self.count:
            raise ValueError("no rows to fit on")
        if not np.isfinite(self.largest):
            raise ValueError("features hold values that are not finite")
        self.bits = scale_bits(self.largest, self.count)
        self.first = np.array([least["v"]])

    def drawn(self, centers: np.ndarray, number: int, wanted: int) -> np.ndarray:
        """`wanted` rows drawn by their costs; fewer if fewer rows lie away from all centres."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                _, cost = nearest(matrix(batch.column(1)), centers)
                keep = pa.array(cost > 0)
                cut = batch.filter(keep)
                yield pa.RecordBatch.from_arrays([cut.column(0), cut.column(1), pa.array(cost[cost > 0])], ["draw", "v", "cost"])

        u = (F.pmod(F.xxhash64("draw", F.lit(number)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        costs = self.rows.mapInArrow(run, "draw long, v array<double>, cost double")
        least = costs.withColumn("time", -F.log(u) / F.col("cost")).orderBy("time", "draw", "v").limit(wanted)
        return np.array([r["v"] for r in least.select("v").collect()]).reshape(-1, centers.shape[1])

    def sums(self, centers: np.ndarray, with_values: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Rows per centre and the exact sums of their scaled values."""
        bits, size = self.bits, centers.shape[1] if with_values else 0

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n: dict[int, int] = {}
            total: dict[int, np.ndarray] = {}
            for batch in pieces(batches):
                x = dense(batch.column(0), centers.shape[1])
                best = nearest_of(x, centers)
                order = np.argsort(best, kind="stable")
                whole = np.rint(np.ldexp(x[order, :size], bits)).astype(np.int64)
                found, at, counts = np.unique(best[order], return_index=True, return_counts=True)
                sums = np.add.reduceat(whole, at, axis=0) if len(found) else whole
                for c, some, each in zip(found.tolist(), sums, counts.tolist()):
                    n[c] = n.get(c, 0) + each
                    total[c] = total.get(c, 0) + some
            found = sorted(n)
            flat = np.concatenate([np.append(total[c], n[c]) for c in found]) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.ListArray.from_arrays(
                    pa.array(np.arange(len(found) + 1) * (size + 1), pa.int32()), pa.array(flat, pa.int64()))], ["cluster", "total"])

        parts = self.stored.mapInArrow(part, "cluster int, total array<long>")
        sums = (parts.select("cluster", F.posexplode("total").alias("place", "x")).filter("x != 0")
                .groupBy("cluster", "place").agg(F.sum("x").alias("x")))
        found = sums.toArrow()  # one number per centre and component
        totals = np.zeros((len(centers), size + 1), np.int64)
        totals[found.column(0).to_numpy(), found.column(1).to_numpy()] = found.column(2).to_numpy()
        return totals[:, -1], totals[:, :-1]


def choose(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int, steps: int = 30) -> np.ndarray:
    """k of the weighted candidates, each drawn by weight and distance to those before it, then moved to their means."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    cost = ((candidates - candidates[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        mass = weights * cost
        if not mass.sum():
            left = [i for i in range(len(candidates)) if cost[i] > 0]  # candidates that no row is nearest to
            if not left:
                break
            mass = np.where(np.isin(np.arange(len(candidates)), left), 1.0, 0.0)
        chosen.append(int(rng.choice(len(candidates), p=mass / mass.sum())))
        cost = np.minimum(cost, ((candidates - candidates[chosen[-1]]) ** 2).sum(axis=1))
    centers = candidates[chosen]
    for _ in range(steps):
        best, _ = nearest(candidates, centers)
        moved = centers.copy()
        for c in range(len(centers)):
            mine = best == c
            if weights[mine].sum():
                moved[c] = (candidates[mine] * weights[mine, None]).sum(axis=0) / weights[mine].sum()
        if np.array_equal(moved, centers):
            break
        centers = moved
    return centers


def fit_centers(df: DataFrame, k: int, iterations: int = 20, seed: int = 1, features: str = "features",
                key: str | None = None, rounds: int = ROUNDS, tolerance: float = 1e-4) -> np.ndarray:
    """Centres in rows. Ends when none has moved by more than `tolerance`."""
    rows = _Rows(df, features, key, seed)
    candidates, number = rows.first, 0
    while number < rounds or len(candidates) < k:
        more = rows.drawn(candidates, number, 2 * k)
        if not len(more):
            break
        candidates, number = np.unique(np.concatenate([candidates, more]), axis=0), number + 1
    if len(candidates) <= k:
        centers = candidates
    else:
        centers = choose(candidates, rows.sums(candidates, with_values=False)[0].astype(float), k, seed)
    for _ in range(iterations):
        counts, totals = rows.sums(centers)
        means = np.ldexp(totals.astype(float) / np.maximum(counts, 1)[:, None], -rows.bits)
        moved = np.where(counts[:, None] > 0, means, centers)
        step = ((moved - centers) ** 2).sum(axis=1).max()
        centers = moved
        if step <= tolerance ** 2:
            break
    return centers


def as_model(spark: SparkSession, centers: np.ndarray, features: str = "features", prediction: str = "prediction") -> KMeansModel:
    """Spark's own model with these centres: it scores, saves and exports like a fitted one."""
    jvm = spark.sparkContext._jvm
    found = _py2java(spark.sparkContext, [Vectors.dense(c) for c in centers])
    inner = jvm.org.apache.spark.mllib.clustering.KMeansModel(found)
    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("kmeans")
    model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(uid, inner))
    return model._set(k=max(len(centers), 2), featuresCol=features, predictionCol=prediction)


class SteadyKMeans(Estimator):
    """The fit as a pipeline stage; the fitted stage is Spark's model."""

    def __init__(self, k: int, iterations: int = 20, seed: int = 1, features: str = "features", prediction: str = "prediction",
                 key: str | None = None) -> None:
        super().__init__()
        self.k, self.iterations, self.seed = k, iterations, seed
        self.features, self.prediction, self.key = features, prediction, key

    def _fit(self, dataset: DataFrame) -> KMeansModel:
        centers = fit_centers(dataset, self.k, self.iterations, self.seed, self.features, self.key)
        return as_model(dataset.sparkSession, centers, self.features, self.prediction)
