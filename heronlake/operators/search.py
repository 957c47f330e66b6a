"""Exact search for the largest inner products that leaves out what cannot win.

No inner product is larger than the product of the two norms. The candidates are packed into matrices in descending order of
norm. Every query first meets the leading matrix, which gives it k scores; the k-th is its threshold. A matrix whose
largest norm times the query's norm lies below the threshold holds none of the query's best, so pairs of query block and
matrix are formed only where some query of the block may still gain, and inside a pair only such queries are multiplied.
The result is that of the full product; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heronlake.functions.vectors import norm
from heronlake.session import settle

#: Rows of a matrix of candidates and of a block of queries.
ROWS, QUERIES = 4_096, 1_024
#: Norms are compared with this much room for rounding.
ROOM = 1 + 1e-9


@dataclass
class Found:
    """result: (query, place, id, score); pairs formed and pairs there are, of query blocks and matrices."""

    result: DataFrame
    formed: int
    pairs: int

    @property
    def skipped(self) -> float:
        return 1 - self.formed / self.pairs if self.pairs else 0.0


def _pack(rows: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Matrices of up to `size` rows, in the order of the rows."""
    def packed(part: pd.DataFrame) -> pd.DataFrame:
        matrix = np.array(part["v"].tolist(), np.float64)
        return pd.DataFrame({"largest": [part["size"].max()], "ids": [part["id"].tolist()], "matrix": [matrix.tobytes()]})

    held = None
    for chunk in rows:
        held = chunk if held is None else pd.concat([held, chunk])
        while len(held) >= size:
            yield packed(held.iloc[:size])
            held = held.iloc[size:]
    if held is not None and len(held):
        yield packed(held)


def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
    """(block, largest, ids, matrix) of rows (id, v), in descending order of norm; null vectors are left out."""
    kind = df.schema["id"].dataType.simpleString()
    rows = df.filter("v is not null").select("id", "v", norm(F.col("v")).alias("size"))
    count = rows.count()
    ordered = rows.repartitionByRange(max(1, -(-count // size)), F.desc("size"), "id").sortWithinPartitions(F.desc("size"), "id")
    packed = ordered.mapInPandas(lambda chunks: _pack(chunks, size), f"largest double, ids array<{kind}>, matrix binary")
    return settle(packed.withColumn("block", F.monotonically_increasing_id()), name)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores of every line, ties to the smaller id; ids ascend."""
    if scores.shape[1] <= k:
        return np.argsort(-scores, axis=1, kind="stable")
    # the k-th largest first, then only what reaches it is sorted
    out = np.empty((len(scores), k), np.int64)
    border = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    for i, line in enumerate(scores):
        reach = np.flatnonzero(line >= border[i])
        out[i] = reach[np.argsort(-line[reach], kind="stable")[:k]]
    return out


def _matrix(ids, matrix: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids in ascending order with their vectors."""
    ids = np.array(ids)
    order = np.argsort(ids, kind="stable")
    return ids[order], np.frombuffer(matrix).reshape(len(ids), -1)[order]


def inner_top(queries: DataFrame, candidates: DataFrame, k: int, rows: int = ROWS, query_rows: int = QUERIES) -> Found:
    """For every query (id, v) the k candidates (id, v) with the largest inner products."""
    spark = queries.sparkSession
    kind, other = (df.schema["id"].dataType.simpleString() for df in (queries, candidates))
    shape = f"query {kind}, id {other}, score double"
    items, asked = blocks(candidates, rows, "item-blocks"), blocks(queries, query_rows, "query-blocks")
    lead = items.orderBy(F.desc("largest"), "block").first()  # one matrix of at most `rows` vectors
    if lead is None:
        return Found(spark.createDataFrame([], f"query {kind}, place int, id {other}, score double"), 0, 0)
    first_ids, first_matrix = _matrix(lead["ids"], lead["matrix"])

    def begin(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            for row in chunk.itertuples():
                mine = np.frombuffer(row.matrix).reshape(len(row.ids), -1)
                scores = mine @ first_matrix.T
                top = best_of(scores, first_ids, k)
                found = np.take_along_axis(scores, top, axis=1)
                border = found[:, -1] if top.shape[1] == k else np.full(len(mine), -np.inf)
                size = np.linalg.norm(mine, axis=1)
                # the least norm with which a candidate may still reach a query's threshold
                reach = np.where(border > 0, border / np.maximum(size, 1e-300), -np.inf)
                yield pd.DataFrame({"block": [row.block], "reach": [float(reach.min())], "reaches": [reach.tolist()],
                                    "best": [first_ids[top].ravel().tolist()], "scores": [found.ravel().tolist()], "each": [top.shape[1]],
                                    "ids": [row.ids], "matrix": [row.matrix]})

    begun = settle(asked.mapInPandas(begin, f"block long, reach double, reaches array<double>, best array<{other}>, scores array<double>, "
                                            f"each int, ids array<{kind}>, matrix binary"), "query-begun")
    left = items.filter(F.col("block") != lead["block"])
    # two small tables of one row per block decide which pairs are formed
    pairs = settle(begun.select(F.col("block").alias("asked"), "reach").join(
        left.select(F.col("block").alias("with"), "largest"), F.col("largest") * ROOM >= F.col("reach")).select("asked", "with"), "block-pairs")

    def multiply(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            for row in chunk.itertuples():
                wanted = np.flatnonzero(row.largest * ROOM >= np.array(row.reaches))
                ids, matrix = _matrix(row.other_ids, row.other)
                mine = np.frombuffer(row.matrix).reshape(len(row.ids), -1)[wanted]
                scores = mine @ matrix.T
                top = best_of(scores, ids, k)
                yield pd.DataFrame({"query": np.repeat(np.array(row.ids)[wanted], top.shape[1]), "id": ids[top].ravel(),
                                    "score": np.take_along_axis(scores, top, axis=1).ravel()})

    others = left.select(F.col("block").alias("with"), "largest", F.col("ids").alias("other_ids"), F.col("matrix").alias("other"))
    work = (pairs.join(begun.select(F.col("block").alias("asked"), "reaches", "ids", "matrix"), "asked").join(others, "with")
            .repartition("asked", "with").select("ids", "matrix", "reaches", "largest", "other_ids", "other"))
    started = begun.select("ids", "best", "scores", "each", F.posexplode("best").alias("at", "id")).select(
        F.get("ids", F.expr("cast(at div each as int)")).alias("query"), "id", F.get("scores", "at").alias("score"))
    found = started.unionByName(work.mapInPandas(multiply, shape))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    result = found.withColumn("place", place).filter(F.col("place") <= k).select("query", "place", "id", "score")
    formed, n_items, n_asked = pairs.count(), items.count(), begun.count()
    return Found(result, formed + n_asked, n_items * n_asked)
