"""Implicit-feedback recommender: preparation, training, evaluation, serving."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.operators import factors, metrics
from heronlake.functions.hashing import mixed, share_of
from heronlake.operators.ordering import positions
from heronlake.operators.relational import left_default
from heronlake.operators.search import inner_top
from heronlake.operators.vectors import similar_to
from heronlake.session import let_go, settle


# --- preparation -----------------------------------------------------------------

def artists(lines: DataFrame) -> DataFrame:
    """(id, name) from 'id<tab>name' lines: cut at the first tab, name trimmed, bad lines dropped."""
    cut = F.locate("\t", F.col("value"))
    rows = lines.filter(cut > 0).select(
        F.substring_index("value", "\t", 1).try_cast("int").alias("id"),
        F.trim(F.expr("substring(value, locate('\t', value) + 1)")).alias("name"))
    # one entry per id, as in a map
    return rows.filter(F.col("id").isNotNull() & (F.col("name") != "")).groupBy("id").agg(F.max("name").alias("name"))


def aliases(lines: DataFrame) -> DataFrame:
    """(bad_id, good_id) from 'bad<tab>good' lines; lines with an empty first part are dropped."""
    parts = F.split("value", "\t")
    rows = lines.select(F.get(parts, F.lit(0)).try_cast("int").alias("bad_id"),
                        F.get(parts, F.lit(1)).try_cast("int").alias("good_id"))
    # one entry per bad id, as in a map
    return rows.dropna().groupBy("bad_id").agg(F.max("good_id").alias("good_id"))


def ratings(plays: DataFrame, alias_map: DataFrame, total: bool = False) -> DataFrame:
    """(user, item, rating) with items by their good id (one hop). total=True adds up equal pairs."""
    rows = left_default(plays, alias_map, "item", "bad_id", "good_id", "good", F.col("item")).select(
        "user", F.col("good").alias("item"), F.col("cnt").cast("double").alias("rating"))
    return rows.groupBy("user", "item").agg(F.sum("rating").alias("rating")) if total else rows


def pair_hash(seed: int = 0, user: str = "user", item: str = "item"):
    """A whole number for each (user, item)."""
    return mixed(mixed(F.col(user), seed) + F.col(item), seed)


def split(rows: DataFrame, share: float, seed: int = 0) -> DataFrame:
    """Adds `part`: a seeded hash of the pair decides, so equal pairs fall on the same side."""
    return rows.withColumn("part", F.when(share_of(pair_hash(seed), share), "train").otherwise("valid"))


def sample(rows: DataFrame, share: float, seed: int = 0) -> DataFrame:
    """The pairs that a seeded hash draws; share down to one in a million (0.0001 is one in ten thousand)."""
    return rows.filter(share_of(pair_hash(seed), share))


# --- predictors -------------------------------------------------------------------

def popularity(train: DataFrame) -> DataFrame:
    """(item, score): plays of each item by all users."""
    return train.groupBy("item").agg(F.sum("rating").alias("score"))


def predict_popularity(train: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A predictor that gives every user the item's popularity, 0.0 for an unknown item."""
    scores = popularity(train)
    return lambda pairs: left_default(pairs, scores.withColumnRenamed("item", "_i"), "item", "_i", "score",
                                      "prediction", F.lit(0.0))


def predict_model(model: ALSModel, score: Callable[[ALSModel, DataFrame], DataFrame] = ALSModel.transform) -> Callable[[DataFrame], DataFrame]:
    """Scores of a factor model; pairs with an unknown user or item are dropped."""
    return lambda pairs: score(model, pairs).filter(~F.isnan("prediction")).withColumn(
        "prediction", F.col("prediction").cast("double"))


#: Blocks and seed of the starting factors; groups of users and of items.
START, GROUPS = (12, 11), 3


def train_implicit(rows: DataFrame, rank: int = 10, iterations: int = 5, reg: float = 0.01, alpha: float = 1.0,
                   blocks: int = START[0], seed: int = START[1], held: tuple[RDD, DataFrame] | None = None) -> ALSModel:
    """Implicit alternating least squares. The starting factors are those of Spark's ALS with users cut into `blocks`, so
    their number is an argument and never comes from the cluster. `held` are the rows in pieces and the starting factors, if there
    are some already."""
    if held is not None:
        return factors.fit_pieces(*held, rank, iterations, reg, alpha, GROUPS)
    return factors.fit(rows, rank, iterations, reg, alpha, blocks, seed, GROUPS)


# --- evaluation --------------------------------------------------------------------

def index_items(items: DataFrame) -> DataFrame:
    """(item, idx) with idx 0, 1, 2 ... in item order; large catalogues are numbered in pieces."""
    rows = items.select("item").distinct().withColumn("_all", F.lit(0))
    return positions(rows, ["_all"], ["item"], F.expr("item div 65536"), out="idx").drop("_all")


#: Places of the item list that one bitmap covers.
PLACES = 1 << 16


def next_free(owned: np.ndarray, draws: np.ndarray, size: int) -> np.ndarray:
    """The first free place from each draw on, among `size` places of which the sorted `owned` ones are taken; -1 if there is
    none up to the end."""
    return next_free_of(owned, np.array([0, len(owned)]), draws, np.zeros(len(draws), np.int64), np.array([size]))


def next_free_of(owned: np.ndarray, at: np.ndarray, draws: np.ndarray, group: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """`next_free` for many lists at once: list g has sizes[g] places and owns owned[at[g]:at[g + 1]]; group says whose a draw is.

    Rank and select: before place d lie d less the owned places below it free ones, r of them; the free place with r free ones
    before it lies at r plus the owned places with at most r free ones before them. Each list has its own range of numbers in
    the two sorted arrays, so one search serves all lists.
    """
    counts, wide = np.diff(at), int(sizes.max(initial=0)) + 1
    of = np.repeat(np.arange(len(counts)), counts)
    rank = draws - (np.searchsorted(of * wide + owned, group * wide + draws) - at[group])
    free_before = of * wide + owned - (np.arange(len(owned)) - at[of])
    place = rank + np.searchsorted(free_before, group * wide + rank, side="right") - at[group]
    return np.where(rank < (sizes - counts)[group], place, -1)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists and where each list begins and the last one ends."""
    return column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])


def negatives(positives: DataFrame, items: DataFrame, seed: int = 1, places: int = PLACES) -> DataFrame:
    """(user, item): for each distinct positive of a user one item the user has not, by a seeded hash.

    Each positive draws a place in the item list; if the user has that item the next one the
    user has not is taken (past the end the list starts again). So a user gets as many negatives as
    positives, none only if the user has all items. The list is cut into stretches of `places`; owned and drawn places
    meet per user and stretch, once, and `next_free_of` finds the free ones of a batch of them. The few draws with no free place left in their
    stretch go to the first free place of the stretches after it.
    """
    index = settle(index_items(items), "item-index")
    size = index.count()
    owned = positives.select("user", "item").distinct().join(index, "item").select("user", "idx")
    draw = F.pmod(pair_hash(seed, item="idx"), F.lit(size))
    both = F.array(F.struct(F.col("idx").alias("place"), F.lit(True).alias("taken")), F.struct(draw.alias("place"), F.lit(False).alias("taken")))
    rows = owned.select("user", F.inline(both)).withColumn("stretch", F.floor(F.col("place") / places).cast("long"))
    kind = positives.schema["user"].dataType.simpleString()
    stretches = -(-size // places)
    grouped = rows.groupBy("user", "stretch").agg(
        F.sort_array(F.collect_list(F.when(F.col("taken"), F.col("place")))).alias("owned"),
        F.collect_list(F.when(~F.col("taken"), F.col("place"))).alias("draws"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.num_rows
            starts = batch.column(1).to_numpy() * places
            widths = np.minimum(places, size - starts)
            (taken, at), (draws, ends) = [_lists(batch.column(c)) for c in (2, 3)]
            taken = taken - np.repeat(starts, np.diff(at))
            group = np.repeat(np.arange(groups), np.diff(ends))
            got = next_free_of(taken, at, draws - starts[group], group, widths)
            first = next_free_of(taken, at, np.zeros(groups, np.int64), np.arange(groups), widths)
            if stretches == 1:
                got = np.where(got < 0, first[group], got)  # the list starts again
            free = got >= 0
            found = np.concatenate([[0], np.cumsum(np.bincount(group[free], minlength=groups))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.ListArray.from_arrays(pa.array(found, pa.int32()), pa.array((got + starts[group])[free], pa.int64())),
                 pa.array(np.bincount(group[~free], minlength=groups), pa.int64()),
                 pa.array(first + starts, pa.int64(), mask=first < 0)], ["user", "stretch", "found", "left", "first"])

    done = grouped.mapInArrow(run, f"user {kind}, stretch long, found array<long>, left long, first long")
    if stretches == 1:
        drawn = done.select("user", F.explode("found").alias("idx"))
    else:
        done = settle(done, "negative-draws")
        # stretches of the user that hold owned places: one number for each, a fraction of the list; the others are free
        over = done.filter("left > 0").select("user", "stretch", "left")
        known = done.join(over.select("user").distinct(), "user", "left_semi").groupBy("user").agg(
            F.map_from_entries(F.collect_list(F.struct("stretch", "first"))).alias("firsts"))
        over = over.join(known, "user")

        def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for user, stretch, left, firsts in zip(*[batch.column(c).to_pylist() for c in range(4)]):
                    firsts = dict(firsts)
                    for step in range(1, stretches + 1):
                        at = (stretch + step) % stretches
                        place = firsts.get(at, at * places)
                        if place is not None:
                            out += [(user, place)] * left
                            break
                yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in out], batch.column(0).type),
                                                  pa.array([p for _, p in out], pa.int64())], ["user", "idx"])

        drawn = done.select("user", F.explode("found").alias("idx")).unionByName(over.mapInArrow(wrap, f"user {kind}, idx long"))
    return drawn.join(index, "idx").select("user", "item")


def labelled_pairs(positives: DataFrame, items: DataFrame) -> DataFrame:
    """(user, item, label): the held-out pairs (1) and as many the user does not have (0)."""
    wanted = positives.select("user", "item").withColumn("label", F.lit(1))
    return wanted.unionByName(negatives(positives, items).withColumn("label", F.lit(0)))


def user_aucs(pairs: DataFrame, predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(user, auc): how often a held-out item scores strictly above one the user has not."""
    return metrics.auc(predict(pairs), ["user"], "prediction", "label", ties=0.0)


def mean_auc(pairs: DataFrame, predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return user_aucs(pairs, predict).agg(
        F.avg("auc").alias("auc"), F.count(F.lit(1)).alias("users"))


def pair_errors(valid: DataFrame, predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Predictions joined back to the true ratings on (user, item)."""
    predicted = predict(valid.select("user", "item").distinct()).select("user", "item", "prediction")
    return predicted.join(valid.select("user", "item", F.col("rating").alias("label")), ["user", "item"])


def grid(train: DataFrame, pairs: DataFrame, ranks: Iterable[int], regs: Iterable[float],
         alphas: Iterable[float], iterations: int = 5) -> list[tuple]:
    """(rank, reg, alpha, auc) for each setting, best first. Only settings loop on the driver.

    `train` and `pairs` move once, to the groups in which all fits solve and score them, and the settings of a rank begin with the
    same stored factors. What a fit has shuffled and kept is let go after it, so the disk holds about two fits beside them (the last one
    may still be in Spark's books), whatever the number of settings.
    """
    spark, found = train.sparkSession, []
    pieces = factors.ratings_of(train, GROUPS)
    labels = F.when(F.col("label") > 0, 1).otherwise(0).alias("rating")
    held = factors.pairs_of(pairs.select("user", "item", labels), GROUPS).persist(StorageLevel.MEMORY_AND_DISK)

    def score(model: ALSModel, _: DataFrame) -> DataFrame:
        return factors.score_pieces(model, held, GROUPS, "int").withColumnRenamed("rating", "label")

    for rank in ranks:
        first = settle(factors.start(pieces, rank, *START, GROUPS), "start-factors")
        for reg in regs:
            for alpha in alphas:
                model = train_implicit(train, rank, iterations, reg, alpha, held=(pieces, first))
                auc = mean_auc(pairs, predict_model(model, score)).first()["auc"]
                found.append((rank, reg, alpha, auc))
                del model
                let_go(spark)
    pieces.unpersist()
    held.unpersist()
    return sorted(found, key=lambda r: -r[3])


# --- serving ----------------------------------------------------------------------------

def with_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    return left_default(rows, names, "item", "id", "name", "name", F.lit(None).cast("string"))


def recommend(model: ALSModel, users: DataFrame, k: int) -> DataFrame:
    """(user, place, item, score): the k best items for each of the given users."""
    return _best(model.userFactors, model.itemFactors, users.select("user"), "user", "item", k)


def recommend_users(model: ALSModel, items: DataFrame, k: int) -> DataFrame:
    """(item, place, user, score): the k best users for each of the given items."""
    return _best(model.itemFactors, model.userFactors, items.select("item"), "item", "user", k)


def _best(own: DataFrame, others: DataFrame, chosen: DataFrame, name: str, other: str, k: int) -> DataFrame:
    vectors = lambda df: df.select("id", F.col("features").cast("array<double>").alias("v"))
    queries = vectors(own).join(chosen.select(F.col(name).alias("id")).distinct(), "id")
    return inner_top(queries, vectors(others), k).result.select(
        F.col("query").alias(name), "place", F.col("id").alias(other), "score")


def similar_items(model: ALSModel, item: int, k: int) -> DataFrame:
    """The k items whose factors point in the direction of the item's factors."""
    vectors = model.itemFactors.select(F.col("id").alias("item"), F.col("features").cast("array<double>").alias("v"))
    return similar_to(vectors, item, k, "item")


def most_listened(rows: DataFrame, k: int) -> DataFrame:
    return popularity(rows).orderBy(F.desc("score"), "item").limit(k)


def history(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(user, item, name) of everything played, once per pair."""
    return with_names(rows.select("user", "item").distinct(), names)
