"""Exact top-k by inner product: tiles of a matrix product, a selection per tile, lists merged in a tree.

Vectors are packed into shards of about `shard_rows` rows and queries into blocks; every block meets every shard once
(the blocks are copied to the shards by an equi-join, the queries being a stated set). A tile of the product keeps
its k best per query. The lists are merged in two levels of windows, first over groups of shards, then over all.

Rows with equal id and vector are one entry with a count, so a frequent row is aggregated before it is moved; at most k + 1
copies of it can matter. A vector with many equal neighbours needs no special route: ties go to the smaller id inside the tile.

Defined cases: vectors that are null or hold a null or a non-finite component take no part, nor do rows without an id;
only vectors of the same length are compared (empty ones score 0 with each other); repeated rows are separate candidates
and separate queries, each without itself; an empty table gives no rows. Scores are whole numbers, exact as long as they
fit in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heronlake.session import settle

SHARD_ROWS = 16_384
QUERY_ROWS = 2_048
TILE_COLUMNS = 4_096
#: Shards whose lists are merged together in the first level of the tree.
FAN_IN = 16
#: Marks the place of the query itself in a list.
LOWEST, NOBODY = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def whole_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """uid, vec_id, v (array of floor(scale * x)), copies: one row per distinct (vec_id, v)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (
        embeddings.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
        .select(F.col("vec_id").cast("long"),
                F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
        .groupBy("vec_id", "v").agg(F.count("*").alias("copies"))
        .withColumn("uid", F.monotonically_increasing_id())
    )


def packed(vectors: DataFrame, key: str) -> DataFrame:
    """One row per (dim, key): uids, ids, copies and the matrix, in order of id."""

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.lexsort((table.column("uid").to_numpy(), ids))
        dim = table.column("dim")[0].as_py()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        matrix = flat.reshape(len(ids), dim)[order]
        big = int(np.abs(matrix).max()) if matrix.size else 0
        kind = "i2" if big < 1 << 15 else "i4" if big < 1 << 31 else "i8"
        return pa.table({
            "dim": pa.array([dim], pa.int32()), key: pa.array([table.column(key)[0].as_py()], pa.int64()),
            "uids": [table.column("uid").to_numpy()[order].tobytes()], "ids": [ids[order].tobytes()],
            "copies": [table.column("copies").to_numpy()[order].tobytes()], "kind": [kind],
            "matrix": [matrix.astype(kind).tobytes()]})

    return vectors.groupBy("dim", key).applyInArrow(
        pack, f"dim int, {key} long, uids binary, ids binary, copies binary, kind string, matrix binary")


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """q @ c.T, exact: in floating point where every sum stays below 2^53, else in whole numbers."""
    most = (int(np.abs(q).max()) if q.size else 0) * (int(np.abs(c).max()) if c.size else 0) * max(1, q.shape[1])
    if most < 1 << 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return q.astype(np.int64) @ c.astype(np.int64).T
    least, top = -(1 << 63), (1 << 63) - 1
    exact = q.astype(object) @ c.astype(object).T
    return np.vectorize(lambda x: min(max(x, least), top), otypes=[np.int64])(exact)


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k greatest scores of each row, of equal ones the first columns."""
    n = scores.shape[1]
    if n <= k:
        return np.argsort(-scores, axis=1, kind="stable")
    if np.abs(scores).max(initial=0) < (1 << 62) // n:
        rank = scores * n + (n - 1 - np.arange(n))
        top = np.argpartition(rank, n - k, axis=1)[:, n - k:]
        order = np.argsort(-np.take_along_axis(rank, top, axis=1), axis=1)
        return np.take_along_axis(top, order, axis=1)
    return np.argsort(-scores, axis=1, kind="stable")[:, :k]


def tile_lists(pairs: DataFrame, k: int) -> DataFrame:
    """For every pair of a query block and a shard: the k best of each query (uid, shard, score, vec_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                q = np.frombuffer(row["q_matrix"], row["q_kind"])
                q_uid = np.frombuffer(row["q_uids"], np.int64)
                q = q.reshape(len(q_uid), dim)
                uid, ids = np.frombuffer(row["uids"], np.int64), np.frombuffer(row["ids"], np.int64)
                times = np.minimum(np.frombuffer(row["copies"], np.int64), k + 1)
                c = np.frombuffer(row["matrix"], row["kind"]).reshape(len(ids), dim)
                at = np.repeat(np.arange(len(ids)), times)  # k + 1 copies of an entry at most
                first = dict(zip(uid[at][::-1].tolist(), range(len(at) - 1, -1, -1)))
                own = np.array([first.get(u, -1) for u in q_uid.tolist()])[:, None]
                best_s, best_i = np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0), np.int64)
                for start in range(0, len(at), TILE_COLUMNS):
                    part = at[start:start + TILE_COLUMNS]
                    s = products(q, c[part])
                    cols = best_of(s, k + 1)  # one more, as the query itself may be among them
                    other = cols + start != own
                    best_s = np.concatenate([best_s, np.where(other, np.take_along_axis(s, cols, 1), LOWEST)], axis=1)
                    best_i = np.concatenate([best_i, np.where(other, ids[part][cols], NOBODY)], axis=1)
                    order = np.lexsort((best_i, np.invert(best_s)), axis=1)[:, :k]
                    best_s, best_i = np.take_along_axis(best_s, order, 1), np.take_along_axis(best_i, order, 1)
                real = best_i != NOBODY
                n = real.sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_uid, n)), pa.array(np.full(int(n.sum()), row["shard"])),
                     pa.array(best_s[real]), pa.array(best_i[real])], ["uid", "shard", "score", "vec_id"])

    return pairs.mapInArrow(run, "uid long, shard long, score long, vec_id long")


def search(embeddings: DataFrame, k: int = 5, every: int = 50, shard_rows: int = SHARD_ROWS,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every vector whose id is divisible by `every`."""
    vectors = settle(whole_vectors(embeddings).withColumn("dim", F.size("v")), "topk-vectors")
    is_query = F.col("vec_id") % every == 0
    n = vectors.agg(F.count("*").alias("n"), F.coalesce(F.sum(is_query.cast("int")), F.lit(0)).alias("q")).first()
    shards, blocks = max(1, -(-n["n"] // shard_rows)), max(1, -(-n["q"] // query_rows))
    candidates = packed(vectors.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards))), "shard")
    queries = packed(vectors.filter(is_query).withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks))), "block")
    spread = queries.select(F.col("dim").alias("q_dim"), F.col("uids").alias("q_uids"), F.col("kind").alias("q_kind"),
                            F.col("matrix").alias("q_matrix"),
                            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("q_shard"))
    pairs = spread.join(candidates, (F.col("q_dim") == F.col("dim")) & (F.col("q_shard") == F.col("shard")))
    lists = tile_lists(pairs, k).withColumn("branch", F.floor(F.col("shard") / FAN_IN))
    order = (F.col("score").desc(), F.col("vec_id"))
    branch = F.row_number().over(Window.partitionBy("uid", "branch").orderBy(*order))
    lists = lists.withColumn("n", branch).filter(F.col("n") <= k)
    lists = lists.withColumn("rank", F.row_number().over(Window.partitionBy("uid").orderBy(*order))).filter(F.col("rank") <= k)
    names = vectors.filter(is_query).select(F.col("uid").alias("q_uid"), F.col("vec_id").alias("query_id"), "copies")
    return (lists.join(names, F.col("uid") == F.col("q_uid"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS uid, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT q.uid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.uid <> c.uid AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
