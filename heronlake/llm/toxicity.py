"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(bias + sum of w_i + sum over pairs of <v_i, v_j>) over the terms a text holds. The pair part lets two
terms count together (an insult beside a group name) in a way that no sum of single weights can.

Terms are the words of the lower-cased text and the starts of words (4, 5 and 6 letters, for inflected and compound
forms), hashed to 2^18 buckets. The model is fitted on a bounded sample of labelled rows: at most `sample_toxic` toxic
and `sample_clean` clean ones, those with the least hash of their id, with all the buckets they hold. The sample is the only
thing that reaches the driver, as bucket numbers. Scoring is one pass over all documents without a shuffle.

Terms that say nothing alone give single weights nothing to go by, and factors that start near zero take long to find them
among thousands of others. So the factors start from the sample's own pairs: the matrix of how much more often than the
single weights explain two terms stand together in toxic rows has large eigenvectors along such terms (found by subspace
iteration over the sparse rows, with and without damping frequent terms). Directions that also tell on a held-back part of
the sample get their size from a small regression; then all weights are fitted by mini-batches, and the epoch with the least
loss on the held-back part is kept. No bucket is left out, but its rate of learning follows its evidence, alone or as part of
such a direction: tens of thousands of terms that say nothing would otherwise learn the sample by heart.

Defined cases: null text is the empty text, whose score is that of the bias; a document labelled more than once is
toxic if any label says so; labels without toxic or id are ignored; without labels of both kinds every score is the
share of toxic ones (0 without labels); repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.llm.common import crc_fold, groups, strings
from heronlake.session import settle

BUCKETS = 1 << 18
STARTS = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")
#: Words whose buckets a worker remembers.
REMEMBERED = 200_000


@dataclass(frozen=True)
class Settings:
    """sample_toxic and sample_clean bound the labelled rows the model is fitted on."""

    sample_toxic: int = 4_000
    sample_clean: int = 8_000
    factors: int = 8
    #: epochs of single weights before the factors start, and of all weights, unless the loss has risen `patience` times running
    warm: int = 5
    epochs: int = 6
    patience: int = 2
    held_back: float = 0.15
    rate: float = 0.02
    #: factors learn at this share of the rate, as they meet in products of many terms
    slow: float = 0.1
    #: evidence (in standard errors) from which a bucket learns at the full rate
    clear: float = 4.0
    #: standard errors from which a direction of pairs is believed on the rows held back
    sure: float = 3.0
    shrink_linear: float = 1e-4
    shrink_pairs: float = 1e-3
    seed: int = 7
    folds: int = 5


@dataclass
class Model:
    """Weights by bucket: column 0 alone, the others in pairs."""

    bias: float
    weights: np.ndarray


def word_buckets(word: str) -> tuple[int, ...]:
    forms = [word, *[f"{n}^{word[:n]}" for n in STARTS if len(word) > n]]
    return tuple(zlib.crc32(f.encode()) % BUCKETS for f in forms)


def text_buckets(text: str) -> set[int]:
    out: set[int] = set()
    for word in set(WORD.findall(text.lower())):
        out.update(word_buckets(word))
    return out


def labelled_sample(labels: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, toxic) of the rows to fit on: at most sample_toxic + sample_clean, from the folds that may be learnt."""
    known = (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
             .filter(crc_fold("doc_id", s.folds) != 0))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return (known.filter("toxic = 1").orderBy(*order).limit(s.sample_toxic)
            .unionByName(known.filter("toxic = 0").orderBy(*order).limit(s.sample_clean))
            .select(F.col("doc_id").alias("s_doc_id"), "toxic"))


def sample_buckets(documents: DataFrame, sample: DataFrame) -> DataFrame:
    """(toxic, buckets) of the sampled documents; buckets as 32-bit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(sorted(text_buckets(t)), "<i4").tobytes() for t in strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["toxic", "buckets"])

    # the sample is bounded by its settings: at most sample_toxic + sample_clean rows of two numbers
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("s_doc_id"))
    return rows.select("toxic", "text").mapInArrow(run, "toxic int, buckets binary")


class Rows:
    """Some rows as a sparse matrix of ones over the buckets that occur in them."""

    def __init__(self, held: list[np.ndarray], toxic: np.ndarray) -> None:
        self.n, self.toxic = len(held), toxic.astype(np.float32)
        sizes = np.array([len(h) for h in held], np.int64)
        row = np.repeat(np.arange(self.n, dtype=np.int32), sizes)
        self.buckets, column = np.unique(np.concatenate(held) if held else np.zeros(0, np.int32), return_inverse=True)
        self.column = column.astype(np.int32)
        order = np.argsort(column, kind="stable")
        self.row_by_column = row[order]
        self.column_starts = np.searchsorted(column[order], np.arange(len(self.buckets)))
        self.filled = np.flatnonzero(sizes)
        self.row_starts = (np.cumsum(sizes) - sizes)[self.filled]

    def times(self, v: np.ndarray) -> np.ndarray:
        """Sum over a row's buckets; v has a line per bucket of these rows."""
        out = np.zeros((self.n, v.shape[1]), np.float32)
        if len(self.column):
            out[self.filled] = np.add.reduceat(v[self.column], self.row_starts, axis=0)
        return out

    def turned(self, r: np.ndarray) -> np.ndarray:
        """Sum over the rows that hold a bucket."""
        if not len(self.column):
            return np.zeros((0, r.shape[1]), np.float32)
        return np.add.reduceat(r[self.row_by_column], self.column_starts, axis=0)

    def values(self, bias: float, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The machine's value and the factor sums of every row."""
        w = weights[self.buckets]
        sums = self.times(np.concatenate([w, (w[:, 1:] ** 2).sum(axis=1, keepdims=True)], axis=1))
        factors = sums[:, 1:-1]
        return bias + sums[:, 0] + 0.5 * ((factors ** 2).sum(axis=1) - sums[:, -1]), factors

    def loss(self, bias: float, weights: np.ndarray) -> float:
        p = sigmoid(self.values(bias, weights)[0])
        return float(-np.mean(np.log(np.where(self.toxic > 0.5, p, 1 - p) + 1e-9)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.asarray(x, np.float64), -500, 500)))


def pair_directions(parts: list[Rows], residuals: list[np.ndarray], size: int, count: int, damping: float,
                    rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Leading eigenvectors of the pair sums: entry (i, j) is the residual of all rows that hold both buckets, 0 for i = j.
    damping: entries are divided by this power of both buckets' numbers of rows."""
    often, alone = np.zeros((size, 1), np.float32), np.zeros((size, 1), np.float32)
    for p, r in zip(parts, residuals):
        often[p.buckets] += p.turned(np.ones((p.n, 1), np.float32))
        alone[p.buckets] += p.turned(r)
    scale = (often + 1) ** -damping

    def product(q: np.ndarray) -> np.ndarray:
        scaled, out = q * scale, np.zeros_like(q)
        for p, r in zip(parts, residuals):
            out[p.buckets] += p.turned(r * p.times(scaled[p.buckets]))
        return (out - alone * scaled) * scale

    q = np.linalg.qr(rng.normal(0, 1, (size, count)).astype(np.float32))[0]
    shift = 0.0
    for _ in range(rounds):
        image = product(q)
        shift = max(shift, float(np.linalg.norm(image, axis=0).max()))
        q = np.linalg.qr(image + 0.5 * shift * q)[0]  # shifted, so that positive eigenvalues lead
    q = q * scale
    return q / (np.abs(q).max(axis=0) + 1e-12)


def regression(x: np.ndarray, offset: np.ndarray, toxic: np.ndarray, free: np.ndarray, positive: slice,
               ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps beside a given offset on the `free` columns; those of `positive` that fall below zero
    are left out."""
    spread = x.std(axis=0) + 1e-6
    spread[0] = 1  # the constant
    x, found, free = x / spread, np.zeros(x.shape[1]), free.copy()
    for _ in range(2):
        for _ in range(25):
            p = sigmoid(offset + x @ found)
            slope = x.T @ (toxic - p) - ridge * found
            curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(found))
            step = np.zeros(len(found))
            step[free] = np.linalg.solve(curve[np.ix_(free, free)], slope[free])
            step *= min(1.0, 2 / max(np.abs(step).max(), 1e-12))
            found += step
            if np.abs(step).max() < 1e-3:
                break
        free[positive] &= found[positive] > 0
        found[~free] = 0
    return found / spread


def standard_score(x: np.ndarray, offset: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """How far each column's product with what the offset leaves unexplained lies from zero, in standard errors."""
    left = toxic - sigmoid(offset)
    x = x - x.mean(axis=0)
    return (x * left[:, None]).sum(axis=0) / np.sqrt(((x * left[:, None]) ** 2).sum(axis=0) + 1e-12)


def single_evidence(parts: list[Rows], size: int) -> np.ndarray:
    """How far a bucket's shares of toxic and of clean rows lie apart, in standard errors; that of rare buckets is less."""
    toxic, clean = np.zeros(size), np.zeros(size)
    for p in parts:
        counts = p.turned(np.stack([p.toxic, 1 - p.toxic], axis=1))
        toxic[p.buckets] += counts[:, 0]
        clean[p.buckets] += counts[:, 1]
    pos, neg = sum(float(p.toxic.sum()) for p in parts), sum(float((1 - p.toxic).sum()) for p in parts)
    share = np.minimum((toxic + clean + 3) / (pos + neg), 0.5)
    return np.abs(toxic / max(pos, 1) - clean / max(neg, 1)) / np.sqrt(share * (1 - share) * (1 / max(pos, 1) + 1 / max(neg, 1)))


def trust(evidence: np.ndarray, s: Settings) -> np.ndarray:
    """Share of the learning rate by evidence: no bucket is left out, but the many that say nothing learn slowly."""
    share = (np.minimum(evidence / s.clear, 1.0) ** 4)[:, None].astype(np.float32)
    return np.concatenate([share, np.repeat(share * np.float32(s.slow), s.factors, axis=1)], axis=1)


def start_factors(parts: list[Rows], check: Rows, bias: float, weights: np.ndarray, s: Settings,
                  rng: np.random.Generator) -> tuple[float, np.ndarray]:
    """Sets the factors (and moves the single weights) by the pairs that the single weights leave unexplained; gives the bias
    and each bucket's part in the directions found, 0 to 1. Only directions that also tell on `check` count."""
    values = [p.values(bias, weights)[0] for p in parts]
    residuals = [(p.toxic - sigmoid(v))[:, None].astype(np.float32) for p, v in zip(parts, values)]
    half = s.factors // 2
    q = np.concatenate([pair_directions(parts, residuals, len(weights), count, damping, rng)
                        for count, damping in ((s.factors - half, 0.0), (half, 0.25)) if count], axis=1).astype(np.float32)
    q *= np.abs(q)  # a direction is to rest on the few terms that carry it
    k = q.shape[1]

    def scores(p: Rows) -> np.ndarray:
        sums = p.times(np.concatenate([q[p.buckets], q[p.buckets] ** 2], axis=1)).astype(np.float64)
        single, squares = sums[:, :k], sums[:, k:]
        return np.concatenate([np.ones((p.n, 1)), single, 0.5 * (single ** 2 - squares)], axis=1)

    sure = standard_score(scores(check), check.values(bias, weights)[0], check.toxic)[1 + k:] > s.sure
    free = np.concatenate([[True], sure, sure])
    found = regression(np.concatenate([scores(p) for p in parts]), np.concatenate(values),
                       np.concatenate([p.toxic for p in parts]), free, slice(1 + k, None))
    sizes = found[1 + k:]
    weights[:, 0] += q @ found[1:1 + k].astype(np.float32)
    weights[:, 1:1 + k] = q * np.sqrt(sizes).astype(np.float32)
    return bias + float(found[0]), np.abs(q[:, sizes > 0]).max(axis=1, initial=0)


def fit_machine(size: int, held: list[np.ndarray], toxic: np.ndarray, s: Settings) -> Model:
    """Weights of `size` buckets by Adam on the log loss over mini-batches; held has the buckets of each sampled row."""
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(held))
    cut = int(len(held) * s.held_back)
    back, rest = order[:cut], order[cut:]
    parts = [Rows([held[i] for i in rest[k:k + 256]], toxic[rest[k:k + 256]]) for k in range(0, len(rest), 256)]
    check = Rows([held[i] for i in back], toxic[back]) if cut else parts[0]
    share = min(max(toxic.mean(), 1e-6), 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    weights = np.zeros((size, 1 + s.factors), np.float32)
    evidence = single_evidence(parts, size)
    rates = s.rate * trust(evidence, s)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    bias_first = bias_second = 0.0
    best, risen, step = (np.inf, bias, weights), 0, 0
    for epoch in range(s.warm + s.epochs):
        if epoch == s.warm:
            bias, found = start_factors(parts, check, bias, weights, s, rng)
            rates = s.rate * trust(np.maximum(evidence, s.clear * found), s)
            weights[:, 1:] += rng.normal(0, 1, (size, s.factors)) * rates[:, 1:]
            best = (check.loss(bias, weights), bias, weights.copy())
        for k in rng.permutation(len(parts)):
            p = parts[k]
            value, factors = p.values(bias, weights)
            slope = ((sigmoid(value) - p.toxic) / p.n).astype(np.float32)[:, None]
            here = weights[p.buckets]
            grad = p.turned(np.concatenate([slope, slope * factors], axis=1))
            grad[:, 1:] += (s.shrink_pairs - grad[:, :1]) * here[:, 1:]
            grad[:, 0] += s.shrink_linear * here[:, 0]
            if epoch < s.warm:
                grad[:, 1:] = 0
            step += 1
            # only the buckets at hand are moved
            first[p.buckets] = 0.9 * first[p.buckets] + 0.1 * grad
            second[p.buckets] = 0.999 * second[p.buckets] + 0.001 * grad ** 2
            weights[p.buckets] -= rates[p.buckets] * (first[p.buckets] / (1 - 0.9 ** step)) / (np.sqrt(second[p.buckets] / (1 - 0.999 ** step)) + 1e-8)
            total = float(slope.sum())
            bias_first, bias_second = 0.9 * bias_first + 0.1 * total, 0.999 * bias_second + 0.001 * total ** 2
            bias -= s.rate * (bias_first / (1 - 0.9 ** step)) / (np.sqrt(bias_second / (1 - 0.999 ** step)) + 1e-8)
        if epoch < s.warm:
            continue
        loss = check.loss(bias, weights)
        if loss < best[0]:
            best, risen = (loss, bias, weights.copy()), 0
        else:
            risen += 1
            if risen == s.patience:
                break
    return Model(best[1], best[2])


def fit(documents: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    rows = settle(sample_buckets(documents, labelled_sample(labels, s)), "toxicity-sample").collect()
    # in an order that does not depend on the partitions
    rows = sorted((bytes(r["buckets"]), r["toxic"]) for r in rows)
    toxic = np.array([t for _, t in rows], np.float64)
    if not len(rows) or toxic.min() == toxic.max():
        share = min(max(toxic.mean() if len(rows) else 0.0, 1e-9), 1 - 1e-9)
        return Model(float(np.log(share / (1 - share))), np.zeros((BUCKETS, 1 + s.factors), np.float32))
    return fit_machine(BUCKETS, [np.frombuffer(b, "<i4") for b, _ in rows], toxic, s)


def score(documents: DataFrame, model: Model, folds: int = Settings.folds) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered: dict[str, tuple[int, ...]] = {}

        def held(text: str) -> np.ndarray:
            found: set[int] = set()
            for word in set(WORD.findall(text.lower())):
                buckets = remembered.get(word)
                if buckets is None:
                    buckets = word_buckets(word)
                    if len(remembered) < REMEMBERED:
                        remembered[word] = buckets
                found.update(buckets)
            return np.fromiter(found, np.int32, len(found))

        for batch in batches:
            texts = strings(batch.column(1))
            for part in groups(texts):
                rows = Rows([np.sort(held(t)) for t in texts[part]], np.zeros(part.stop - part.start))
                values = rows.values(model.bias, model.weights)[0]
                ids = batch.column(0).slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([ids, pa.array(sigmoid(values), pa.float64())], ["doc_id", "score"])

    scored = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (crc_fold("doc_id", folds) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def classify(documents: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    return score(documents, fit(documents, labels, s), s.folds)
