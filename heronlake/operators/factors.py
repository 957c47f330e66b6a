"""Alternating least squares with the start, the equations and the model of Spark's ALS, and less to move.

Spark cuts users and items into blocks, sends every factor to each block that needs it, a dozen times a half step, and moves the
ratings three times. Here the ratings move once, packed, to `groups` groups of users and as many of items, where they stay in
pieces that Spark keeps; a half step sends the factors of the other side, packed, once to each group. A group solves its pieces
one after the other, so a task holds the factors of one side and one piece of ratings. More groups run at the same time,
and move more; they change nothing but rounding. The starting factors are those of Spark's ALS for the same seed and blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heronlake.operators.packed import (BUCKETS, ITEMS, PACKED, PIECE, ROWS, USERS, find, group_of, loosen, pieces_of, place_of,
                                        solve, squeeze, together)
from heronlake.session import settle


# --- packing ------------------------------------------------------------------------

def _packed(rows: DataFrame, sides: tuple[int, ...], groups: int) -> RDD:
    """(side * groups + group, (bucket, n, own ids, other ids, ratings)): each rating once for each of the sides."""
    kind = np.float32 if dict(rows.dtypes)["rating"] == "float" else np.float64

    def pack(user: np.ndarray, item: np.ndarray, rating: np.ndarray) -> Iterator[tuple]:
        for side in sides:
            own, other = (user, item) if side == USERS else (item, user)
            h = group_of(own)
            bucket = h % (groups * BUCKETS)
            order = np.lexsort((other, own, bucket))
            own, other, value, bucket = own[order], other[order], rating[order], bucket[order]
            borders = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
            for a, b in zip(borders[:-1], borders[1:]):
                g, part = divmod(int(bucket[a]), BUCKETS)
                step = np.diff(own[a:b], prepend=np.int32(0))  # small numbers; what runs over runs back
                yield side * groups + g, part, int(b - a), squeeze(step), squeeze(other[a:b]), squeeze(value[a:b])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            for row in pack(*[np.concatenate([h[c] for h in held]) for c in range(3)]):
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], ["place", "bucket", "n", "own", "other", "rating"])

        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(kind)])
            n += batch.num_rows
            if n >= PACKED:
                yield from out(held)
                held, n = [], 0
        if held:
            yield from out(held)

    packed = rows.select("user", "item", "rating").mapInArrow(
        cut, "place long, bucket long, n long, own binary, other binary, rating binary")
    return packed.rdd.map(lambda r: (r[0], (r[1], r[2], bytes(r[3]), bytes(r[4]), bytes(r[5]), np.dtype(kind).str)))


def grouped(rows: DataFrame, sides: tuple[int, ...], groups: int) -> RDD:
    """The ratings in pieces, by group of users and by group of items."""
    moved = _packed(rows, sides, groups).partitionBy(2 * groups, place_of)
    return moved.mapPartitions(pieces_of, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)


def as_chunks(factors: DataFrame) -> RDD:
    """(ids, matrix, n) of rows (id, features), packed."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            ids = np.concatenate([h[0] for h in held])
            matrix = np.concatenate([h[1] for h in held])
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in (squeeze(ids), squeeze(matrix), len(ids))], ["ids", "matrix", "n"])

        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy()))
                n += batch.num_rows
                if n >= ROWS:
                    yield out(held)
                    held, n = [], 0
        if held:
            yield out(held)

    return factors.select("id", "features").mapInArrow(pack, "ids binary, matrix binary, n long").rdd.map(
        lambda r: (bytes(r[0]), bytes(r[1]), r[2]))


def as_rows(chunks: RDD, rank: int) -> DataFrame:
    """(id, features) of packed factors."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, matrix, n in zip(*[c.to_pylist() for c in batch.columns]):
                values = pa.array(loosen(matrix, n * rank, np.float32))
                features = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * rank), values)
                yield pa.RecordBatch.from_arrays([pa.array(loosen(ids, n, np.int32)), features], ["id", "features"])

    return chunks.toDF("ids binary, matrix binary, n long").mapInArrow(unpack, "id int, features array<float>")


# --- half steps -----------------------------------------------------------------------

def _half(chunks: RDD, pieces: RDD, side: int, groups: int, rank: int, reg: float, alpha: float | None) -> RDD:
    """The packed factors of one side from those of the other."""
    def run(records: Iterable[tuple]) -> Iterator[tuple]:
        got, known, every = [], None, np.zeros((rank, rank))
        for place, (kind, *rest) in records:  # factors come before pieces
            if place // groups != side:
                return
            if kind is not None:
                got.append((kind, *rest))
                continue
            if known is None:
                known, matrix = together(got, rank)
                got.clear()
                if alpha is not None:
                    for at in range(0, len(matrix), ROWS):
                        some = matrix[at:at + ROWS].astype(np.float64)
                        every += some.T @ some
            ids, counts, others, which, ratings = rest
            found = solve(counts, matrix[np.searchsorted(known, others)], which, ratings, reg, alpha, every)
            for at in range(0, len(ids), ROWS):
                yield squeeze(ids[at:at + ROWS]), squeeze(found[at:at + ROWS]), len(ids[at:at + ROWS])

    sent = chunks.flatMap(lambda c: [(side * groups + g, c) for g in range(groups)]).partitionBy(2 * groups, place_of)
    return _with(sent, pieces).mapPartitions(run)


def _with(sent: RDD, pieces: RDD) -> RDD:
    """What was sent to a group before its pieces, which stay where they are."""
    both = sent.union(pieces)
    if both.getNumPartitions() != pieces.getNumPartitions():
        raise RuntimeError("factors and ratings are not cut alike")
    return both


def _checked(rows: DataFrame, kind: str = "float") -> DataFrame:
    """(user, item, rating) as Spark's ALS takes them: no nulls, whole ids, finite ratings."""
    def sound(c: str, to: str, bad: Column) -> Column:
        return F.when(bad, F.raise_error(F.lit(f"{c} is null or not finite")).cast(to)).otherwise(F.col(c).cast(to)).alias(c)

    rating = F.col("rating")
    odd = rating.isNull() | F.isnan("rating") | (F.abs(rating) == float("inf"))
    return rows.select(*[sound(c, "int", F.col(c).isNull()) for c in ("user", "item")], sound("rating", kind, odd))


def _users_of(pieces: RDD, groups: int) -> DataFrame:
    """(user) of all pieces by user; each user is in one of them."""
    ids = pieces.filter(lambda p: p[0] < groups).map(lambda p: (squeeze(p[1][1]), len(p[1][1])))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, n in zip(*[c.to_pylist() for c in batch.columns]):
                yield pa.RecordBatch.from_arrays([pa.array(loosen(data, n, np.int32))], ["user"])

    return ids.toDF("ids binary, n long").mapInArrow(unpack, "user int")


def start(pieces: RDD, rank: int, blocks: int, seed: int, groups: int) -> DataFrame:
    """(id, features): the user factors a fit of `pieces` begins with, the same for any iterations, reg and alpha."""
    # without an iteration Spark's ALS returns the factors it starts from; they follow from the users, their blocks and the seed
    users = _users_of(pieces, groups).select("user", F.pmod("user", F.lit(blocks)).alias("item"), F.lit(1.0).alias("rating"))
    return ALS(rank=rank, maxIter=0, seed=seed, userCol="user", itemCol="item", ratingCol="rating", numUserBlocks=blocks,
               numItemBlocks=blocks).fit(users).userFactors


def ratings_of(rows: DataFrame, groups: int) -> RDD:
    """The ratings in pieces of both sides, for `fit_pieces`; kept until they are unpersisted."""
    return grouped(_checked(rows), (USERS, ITEMS), groups)


def fit_pieces(pieces: RDD, first: DataFrame, rank: int, iterations: int, reg: float, alpha: float | None, groups: int) -> ALSModel:
    """The model of ratings that are in pieces already, from the user factors `first`."""
    if iterations < 1:
        raise ValueError("at least one iteration")
    mine = as_chunks(first)
    for left in reversed(range(iterations)):
        theirs = _half(mine, pieces, ITEMS, groups, rank, reg, alpha)
        if not left:  # the last step reads it and so does the model; kept before that step is built on it, or it is solved twice
            theirs.persist(StorageLevel.MEMORY_AND_DISK)
        mine = _half(theirs, pieces, USERS, groups, rank, reg, alpha)
    item_factors = settle(as_rows(theirs, rank), "item-factors")
    user_factors = settle(as_rows(mine, rank), "user-factors")
    theirs.unpersist()
    jvm = first.sparkSession.sparkContext._jvm
    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("als")
    model = ALSModel(jvm.org.apache.spark.ml.recommendation.ALSModel(uid, rank, user_factors._jdf, item_factors._jdf))
    return model._set(userCol="user", itemCol="item", coldStartStrategy="drop")


def fit(rows: DataFrame, rank: int, iterations: int, reg: float, alpha: float | None = None, blocks: int = 10, seed: int = 1,
        groups: int = 3) -> ALSModel:
    """Spark's model of (user, item, rating): of explicit ratings without `alpha`, of implicit ones with it."""
    if iterations < 1:
        raise ValueError("at least one iteration")
    pieces = ratings_of(rows, groups)
    model = fit_pieces(pieces, start(pieces, rank, blocks, seed, groups), rank, iterations, reg, alpha, groups)
    pieces.unpersist()
    return model


# --- scoring ----------------------------------------------------------------------------

def score(model: ALSModel, rows: DataFrame, groups: int = 3) -> DataFrame:
    """(user, item, rating, prediction) of the rows whose user and item the model knows, as model.transform gives them. Nulls
    and ratings that are not finite are refused as in a fit.

    The rows move once, packed, to their user's group, and meet the group's user factors and all item factors there, where two
    joins would send every row along with a vector.
    """
    return score_pieces(model, pairs_of(rows, groups), groups, dict(rows.dtypes)["rating"])


def pairs_of(rows: DataFrame, groups: int) -> RDD:
    """The rows in pieces of their users, for `score_pieces`."""
    kind = dict(rows.dtypes)["rating"]
    return _packed(_checked(rows, kind), (USERS,), groups).partitionBy(groups, place_of).mapPartitions(pieces_of, preservesPartitioning=True)


def score_pieces(model: ALSModel, pieces: RDD, groups: int, kind: str) -> DataFrame:
    """`score` of rows that are in pieces already; kind is the type of their ratings."""
    rank = model.rank

    def mine(chunk: tuple) -> Iterator[tuple]:
        ids, matrix = together([chunk], rank)
        g = group_of(ids) % (groups * BUCKETS) // BUCKETS
        for i in np.unique(g).tolist():
            yield i, (squeeze(ids[g == i]), squeeze(matrix[g == i]), int((g == i).sum()), USERS)

    def run(records: Iterable[tuple]) -> Iterator[tuple]:
        got, sides = ([], []), None
        for _, (first, *rest) in records:  # factors come before pieces
            if first is not None:
                got[rest[-1]].append((first, *rest[:-1]))
                continue
            if sides is None:
                sides = [together(chunks, rank) for chunks in got]
                got[USERS].clear(), got[ITEMS].clear()
            ids, counts, others, which, ratings = rest
            (at, there), (of, found) = [find(known_ids, wanted) for (known_ids, _), wanted in zip(sides, (ids, others))]
            user = np.repeat(np.arange(len(ids)), counts)
            for a in range(0, len(which), PIECE):
                u, i, r = user[a:a + PIECE], which[a:a + PIECE], ratings[a:a + PIECE]
                both = there[u] & found[i]
                u, i, r = u[both], i[both], r[both]
                left, right = sides[USERS][1], sides[ITEMS][1]
                value = np.zeros(len(u), np.float32)
                for c in range(rank):  # in single precision and in order, as Spark adds them
                    value += left[at[u], c] * right[of[i], c]
                yield ids[u].tobytes(), others[i].tobytes(), r.tobytes(), r.dtype.str, value.tobytes()

    sent = as_chunks(model.userFactors).flatMap(mine).union(
        as_chunks(model.itemFactors).flatMap(lambda c: [(g, (*c, ITEMS)) for g in range(groups)])).partitionBy(groups, place_of)
    scored = _with(sent, pieces).mapPartitions(run).toDF("user binary, item binary, rating binary, kind string, prediction binary")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for user, item, rating, sort, value in zip(*[c.to_pylist() for c in batch.columns]):
                columns = [(user, np.int32), (item, np.int32), (np.frombuffer(rating, sort).astype(np.float64), np.float64), (value, np.float32)]
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(data, t)) for data, t in columns],
                                                 ["user", "item", "rating", "prediction"])

    out = scored.mapInArrow(unpack, "user int, item int, rating double, prediction float")
    return out.withColumn("rating", F.col("rating").cast(kind))
