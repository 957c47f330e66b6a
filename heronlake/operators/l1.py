"""A linear support vector machine with an L1 penalty, by proximal gradient steps over blocks of rows.

Minimises mean hinge loss + reg * sum of |w|. Rows are packed once into matrices (label in the sign) and stored; a pass over
them is one job that multiplies every block with the weights at hand and adds up gradient, losses and rows with partial
sums, so one row of numbers as long as the weights comes back. The hinge is rounded off over a width that shrinks in
rounds; each round takes accelerated steps (gradient, then a soft threshold that makes small weights exactly zero)
and begins anew when a step leads upwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.session import settle

#: Widths over which the hinge is rounded off, from round to round.
WIDTHS = (0.5, 0.1, 0.02)


@dataclass(frozen=True)
class L1Machine:
    weights: np.ndarray
    objective: float
    passes: int
    intercept: float = 0.0


def soft(w: np.ndarray, by: float) -> np.ndarray:
    return np.sign(w) * np.maximum(np.abs(w) - by, 0)


def _blocks(df: DataFrame, features: str, label: str) -> DataFrame:
    """(rows, matrix) of features with the sign of their label; rows without label or features are left out."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sign = np.where(batch.column(0).to_numpy() > 0, 1.0, -1.0)
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([(flat * sign[:, None]).tobytes()])], ["n", "matrix"])

    rows = df.filter(F.col(label).isNotNull() & F.col(features).isNotNull())
    return settle(rows.select(F.col(label).cast("double"), vector_to_array(features).alias("v")).mapInArrow(pack, "n long, matrix binary"),
                  "signed-blocks")


class _Passes:
    """Sums over all rows for some weights."""

    def __init__(self, blocks: DataFrame) -> None:
        self.blocks, self.count = blocks, 0

    def _sums(self, of) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [of(np.frombuffer(m).reshape(n, -1)).tolist() for n, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.float64()))], ["sums"])

        self.count += 1
        rows = self.blocks.mapInArrow(run, "sums array<double>").select(array_to_vector("sums").alias("sums"))
        return rows.agg(Summarizer.sum(F.col("sums")).alias("s")).first()["s"].toArray()

    def slope(self, w: np.ndarray, width: float, shown: np.ndarray) -> tuple[np.ndarray, float, float]:
        """Gradient and value of the rounded loss at w, and the plain hinge loss at `shown`; sums over all rows."""
        def of(x: np.ndarray) -> np.ndarray:
            short = 1 - x @ w
            part = np.clip(short / width, 0, 1)
            value = np.where(short > width, short - width / 2, part * np.maximum(short, 0) / 2)
            return np.concatenate([-(part @ x), [value.sum(), np.maximum(1 - x @ shown, 0).sum()]])

        sums = self._sums(of)
        return sums[:-2], sums[-2], sums[-1]

    def image(self, v: np.ndarray) -> np.ndarray:
        return self._sums(lambda x: (x @ v) @ x)


def fit_l1(df: DataFrame, iterations: int = 200, reg: float = 0.1, features: str = "features", label: str = "label",
           tolerance: float = 1e-5, seed: int = 1) -> L1Machine:
    """Takes at most `iterations` passes; ends a round when the objective has not moved by `tolerance` of itself in five steps."""
    blocks = _blocks(df, features, label).persist()
    try:
        n = blocks.agg(F.sum("n")).first()[0]
        if not n:
            raise ValueError("no rows to fit on")
        first = blocks.select("n", "matrix").first()
        passes, size = _Passes(blocks), len(first["matrix"]) // 8 // first["n"]
        # the largest eigenvalue of the rows' products bounds the gradient's change
        v = np.random.default_rng(seed).normal(0, 1, size)
        for _ in range(6):
            v = passes.image(v / max(np.linalg.norm(v), 1e-300))
        steep = 1.2 * max(np.linalg.norm(v), 1e-12) / n
        w = np.zeros(size)
        best, best_value = w, np.inf
        for width in WIDTHS:
            rate = width / steep
            ahead, last, pace, seen, before = w, w, 1.0, [], np.inf
            while passes.count < iterations:
                grad, value, plain = passes.slope(ahead, width, last)
                objective = plain / n + reg * np.abs(last).sum()
                if objective < best_value:
                    best, best_value = last, objective
                seen.append(objective)
                if len(seen) > 5 and seen[-6] - min(seen[-5:]) <= tolerance * abs(seen[-6]):
                    break
                if value / n > 1.5 * before + 1:  # the bound was too low
                    rate /= 2
                before = value / n
                now = soft(ahead - rate * grad / n, rate * reg)
                if (ahead - now) @ (now - last) > 0:
                    pace = 1.0  # the momentum leads upwards
                following = (1 + np.sqrt(1 + 4 * pace ** 2)) / 2
                ahead, last, pace = now + (pace - 1) / following * (now - last), now, following
            w = best
        return L1Machine(best, float(best_value), passes.count)
    finally:
        blocks.unpersist()
