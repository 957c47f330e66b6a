"""Recommender jobs on listening data."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from heronlake.operators import metrics
from heronlake.operators import reco as ops
from heronlake.operators.relational import distinct_counts, left_default
from heronlake.plans import oracle as o
from heronlake.registry import job
from heronlake.session import fresh_dir, settle, written_once
from heronlake.sources import files
from heronlake.sources.tables import alias_lines, artist_lines, plays

# --- SQL of the preparation ---------------------------------------------------------

ARTISTS = f"""{o.ARTIST_LINES}, artists AS (SELECT id, max(name) AS name FROM (
    SELECT TRY_CAST(split_part(value, chr(9), 1) AS INTEGER) AS id,
           trim(substr(value, strpos(value, chr(9)) + 1)) AS name
    FROM artist_lines WHERE strpos(value, chr(9)) > 0) WHERE id IS NOT NULL AND name <> '' GROUP BY id)"""
ALIASES = f"""{o.ALIAS_LINES}, aliases AS (SELECT TRY_CAST(split_part(value, chr(9), 1) AS INTEGER) AS bad_id,
    TRY_CAST(split_part(value, chr(9), 2) AS INTEGER) AS good_id FROM alias_lines
    WHERE TRY_CAST(split_part(value, chr(9), 1) AS INTEGER) IS NOT NULL)"""
RATINGS = f"""{o.PLAYS}, {ALIASES}, ratings AS (SELECT "user", coalesce(good_id, item) AS item,
    CAST(cnt AS DOUBLE) AS rating FROM plays LEFT JOIN aliases ON item = bad_id)"""
def pair_hash(item: str, seed: int) -> str:
    return o.mixed(f"{o.mixed(chr(34) + 'user' + chr(34), seed)} + {item}", seed)


SPLIT = f"""{RATINGS}, parts AS (SELECT *, CASE WHEN {pair_hash("item", 0)} % 1000000 < 900000 THEN 'train' ELSE 'valid' END
    AS part FROM ratings),
  popular AS (SELECT item, sum(rating) AS score FROM parts WHERE part = 'train' GROUP BY item)"""
NEGATIVES = f"""{SPLIT}, item_index AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS idx
    FROM (SELECT DISTINCT item FROM ratings)),
  total AS (SELECT count(*) AS size FROM item_index),
  owned AS (SELECT DISTINCT "user", idx FROM parts JOIN item_index USING (item) WHERE part = 'valid'),
  twice AS (SELECT "user", idx FROM owned UNION ALL SELECT "user", idx + size FROM owned, total),
  ranked AS (SELECT "user", idx, idx - row_number() OVER (PARTITION BY "user" ORDER BY idx) AS run FROM twice),
  held AS (SELECT "user", idx, run, max(idx) OVER (PARTITION BY "user", run) AS last,
    min(idx) OVER (PARTITION BY "user", run) AS first FROM ranked),
  draws AS (SELECT "user", {pair_hash("idx", 1)} % size AS draw FROM owned, total),
  drawn AS (SELECT d."user", CASE WHEN h.idx IS NULL THEN draw ELSE (last + 1) % size END AS idx
    FROM total, draws d LEFT JOIN held h ON h."user" = d."user" AND h.idx = d.draw
    WHERE h.idx IS NULL OR last - first + 1 < size),
  negatives AS (SELECT "user", item FROM drawn JOIN item_index USING (idx))"""


def play_rows(spark, sf_dir):
    """The listening data read back from blank-separated lines."""
    def write(path):
        line = F.concat_ws(" ", *[F.col(c).cast("string") for c in ("user", "item", "cnt")])
        files.write_lines(plays(spark, sf_dir).select(line.alias("value")), path, compression="gzip")

    path = written_once(spark, sf_dir, "plays", write)
    return files.read_delimited(spark, path, "user int, item int, cnt int", sep=" ")


def artists(spark, sf_dir):
    return ops.artists(artist_lines(spark, sf_dir))


def alias_map(spark, sf_dir):
    return ops.aliases(alias_lines(spark, sf_dir))


def ratings(spark, sf_dir):
    return ops.ratings(play_rows(spark, sf_dir), alias_map(spark, sf_dir))


def train_valid(spark, sf_dir):
    """The two parts of the ratings, joined and split once and stored by part."""
    def write(path):
        ops.split(ratings(spark, sf_dir), 0.9).write.partitionBy("part").parquet(path)

    parts = spark.read.parquet(written_once(spark, sf_dir, "reco-parts", write))
    return parts.filter("part = 'train'").drop("part"), parts.filter("part = 'valid'").drop("part")


# --- preparation -----------------------------------------------------------------------

@job("reco_artist_by_id", f"WITH {ARTISTS} SELECT id, name FROM artists")
def reco_artist_by_id(spark, sf_dir):
    return artists(spark, sf_dir)


@job("reco_alias_map", f"WITH {ALIASES} SELECT bad_id, good_id FROM aliases")
def reco_alias_map(spark, sf_dir):
    return alias_map(spark, sf_dir)


@job("reco_artist_lookup", f"WITH {ARTISTS} SELECT name FROM artists WHERE id = 51")
def reco_artist_lookup(spark, sf_dir):
    return artists(spark, sf_dir).filter(F.col("id") == 51).select("name")


@job("reco_alias_names", f"""WITH {ARTISTS}, {ALIASES} SELECT bad_id, b.name AS bad_name, good_id, g.name AS good_name
    FROM aliases LEFT JOIN artists b ON b.id = bad_id LEFT JOIN artists g ON g.id = good_id""")
def reco_alias_names(spark, sf_dir):
    names, none = artists(spark, sf_dir), F.lit(None).cast("string")
    rows = left_default(alias_map(spark, sf_dir), names, "bad_id", "id", "name", "bad_name", none)
    return left_default(rows, names, "good_id", "id", "name", "good_name", none)


@job("reco_explore", f"WITH {o.PLAYS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS field, count({c}) AS cnt, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS stdev,
        max({c}) AS max_value, min({c}) AS min_value, count(DISTINCT {c}) AS n_distinct FROM plays"""
    for c in ('"user"', "item", "cnt")).replace("'\"user\"'", "'user'"))
def reco_explore(spark, sf_dir):
    """Statistics of all three fields."""
    fields = ["user", "item", "cnt"]
    aggs = []
    rows = play_rows(spark, sf_dir)
    for c in fields:
        aggs.append(F.struct(
            F.lit(c).alias("field"), F.count(c).alias("cnt"), F.round(F.avg(c), 6).alias("mean"),
            F.round(F.stddev_pop(c), 6).alias("stdev"), F.max(c).alias("max_value"), F.min(c).alias("min_value")))
    stats = rows.agg(F.array(*aggs).alias("rows")).select(F.inline("rows"))
    return stats.join(distinct_counts(rows, fields).withColumnRenamed("column", "field"), "field")


@job("distinct_items", f"WITH {o.PLAYS} SELECT count(DISTINCT item) AS n_items, count(DISTINCT \"user\") AS n_users FROM plays")
def distinct_items(spark, sf_dir):
    counts = distinct_counts(play_rows(spark, sf_dir), ["item", "user"])
    pick = lambda c: F.max(F.when(F.col("column") == c, F.col("n_distinct")))
    return counts.agg(pick("item").alias("n_items"), pick("user").alias("n_users"))


@job("reco_ratings", f'WITH {RATINGS} SELECT "user", item, rating FROM ratings')
def reco_ratings(spark, sf_dir):
    return ratings(spark, sf_dir)


@job("reco_split", f'WITH {SPLIT} SELECT "user", item, rating, part FROM parts')
def reco_split(spark, sf_dir):
    return ops.split(ratings(spark, sf_dir), 0.9)


@job("reco_sample", f'WITH {RATINGS} SELECT "user", item, rating FROM ratings WHERE {pair_hash("item", 5)} % 1000000 < 100')
def reco_sample(spark, sf_dir):
    """One pair in ten thousand."""
    return ops.sample(ratings(spark, sf_dir), 0.0001, seed=5)


@job("reco_names_of_items", f"WITH {ARTISTS}, {RATINGS} SELECT id, name FROM artists WHERE id IN (SELECT item FROM ratings)")
def reco_names_of_items(spark, sf_dir):
    played = ratings(spark, sf_dir).select(F.col("item").alias("id")).distinct()
    return artists(spark, sf_dir).join(played, "id", "left_semi")


@job("reco_user_history", f"""WITH {ARTISTS}, {RATINGS} SELECT DISTINCT "user", item, name
    FROM ratings LEFT JOIN artists ON item = id""")
def reco_user_history(spark, sf_dir):
    return ops.history(ratings(spark, sf_dir), artists(spark, sf_dir))


@job("reco_most_listened", f"""WITH {RATINGS} SELECT item, sum(rating) AS score FROM ratings GROUP BY item
    ORDER BY score DESC, item LIMIT 10""")
def reco_most_listened(spark, sf_dir):
    return ops.most_listened(ratings(spark, sf_dir), 10)


# --- popularity predictor and its evaluation -----------------------------------------------

@job("reco_popularity_scores", f"""WITH {SPLIT} SELECT "user", p.item, coalesce(score, 0.0) AS prediction
    FROM parts p LEFT JOIN popular q ON p.item = q.item WHERE part = 'valid'""")
def reco_popularity_scores(spark, sf_dir):
    train, valid = train_valid(spark, sf_dir)
    return ops.predict_popularity(train)(valid.select("user", "item"))


def auc_pairs(spark, sf_dir):
    """The pairs all AUC jobs score, drawn once."""
    def write(path):
        train, valid = train_valid(spark, sf_dir)  # both parts together are all ratings, joined and stored already
        ops.labelled_pairs(valid, train.select("item").unionByName(valid.select("item"))).write.parquet(path)

    return spark.read.parquet(written_once(spark, sf_dir, "auc-pairs", write))


@job("reco_negative_samples", f'WITH {NEGATIVES} SELECT "user", item FROM negatives')
def reco_negative_samples(spark, sf_dir):
    return auc_pairs(spark, sf_dir).filter("label = 0").drop("label")


@job("reco_auc_popularity", f"""WITH {NEGATIVES}, pos AS (SELECT "user", coalesce(score, 0.0) AS score
      FROM parts p LEFT JOIN popular q ON p.item = q.item WHERE part = 'valid'),
    neg AS (SELECT "user", coalesce(score, 0.0) AS score FROM negatives n LEFT JOIN popular q ON n.item = q.item),
    per_user AS (SELECT "user", avg(CASE WHEN pos.score > neg.score THEN 1.0 ELSE 0.0 END) AS auc
      FROM pos JOIN neg USING ("user") GROUP BY "user")
    SELECT round(avg(auc), 6) AS auc, count(*) AS users FROM per_user""")
def reco_auc_popularity(spark, sf_dir):
    train, _ = train_valid(spark, sf_dir)
    result = ops.mean_auc(auc_pairs(spark, sf_dir), ops.predict_popularity(train))
    return result.select(F.round("auc", 6).alias("auc"), "users")


ERRORS = f"""WITH {SPLIT}, pairs AS (SELECT coalesce(score, 0.0) AS prediction, rating AS label
    FROM parts p LEFT JOIN popular q ON p.item = q.item WHERE part = 'valid')"""


def popularity_errors(spark, sf_dir):
    train, valid = train_valid(spark, sf_dir)
    return ops.pair_errors(valid, ops.predict_popularity(train))


@job("join_pred_actual", f"""WITH {SPLIT} SELECT "user", p.item, coalesce(score, 0.0) AS prediction, rating AS label
    FROM parts p LEFT JOIN popular q ON p.item = q.item WHERE part = 'valid'""")
def join_pred_actual(spark, sf_dir):
    return popularity_errors(spark, sf_dir)


@job("reco_mse", f"{ERRORS} SELECT round(avg((prediction - label) ** 2), 4) AS mse FROM pairs")
def reco_mse(spark, sf_dir):
    m = metrics.regression_metrics(popularity_errors(spark, sf_dir))
    return m.select(F.round("mse", 4).alias("mse"))


@job("reco_rmse", f"""{ERRORS} SELECT round(sqrt(avg((prediction - label) ** 2)), 4) AS rmse,
    round(avg((prediction - label) ** 2), 4) AS mse,
    round(1 - avg((prediction - label) ** 2) / var_pop(label), 4) AS r2 FROM pairs""")
def reco_rmse(spark, sf_dir):
    m = metrics.regression_metrics(popularity_errors(spark, sf_dir))
    return m.select(*[F.round(c, 4).alias(c) for c in ("rmse", "mse", "r2")])


# --- factor model ------------------------------------------------------------------------------

def model_of(spark, sf_dir) -> ALSModel:
    """Trained on the training part once, saved in the shared folder, loaded by every job. The fit reads its rows once, so the
    parts are not stored for it."""
    def write(path):
        train = ops.split(ratings(spark, sf_dir), 0.9).filter("part = 'train'")
        ops.train_implicit(train).write().overwrite().save(path)

    return ALSModel.load(written_once(spark, sf_dir, "als", write))


@job("reco_factors", f"""WITH {SPLIT} SELECT DISTINCT 'user' AS kind, "user" AS id, CAST(10 AS INTEGER) AS rank FROM parts
    WHERE part = 'train' UNION ALL SELECT DISTINCT 'item', item, CAST(10 AS INTEGER) FROM parts WHERE part = 'train'""")
def reco_factors(spark, sf_dir):
    """The ids that have factors, and how many; the factors themselves are reco_factor_preview."""
    model = model_of(spark, sf_dir)
    users = model.userFactors.select(F.lit("user").alias("kind"), "id", F.size("features").alias("rank"))
    items = model.itemFactors.select(F.lit("item").alias("kind"), "id", F.size("features").alias("rank"))
    return users.unionByName(items)


@job("reco_factor_preview")
def reco_factor_preview(spark, sf_dir):
    """The factors of the ten first users and items."""
    model = model_of(spark, sf_dir)
    first = lambda df, kind: df.orderBy("id").limit(10).select(F.lit(kind).alias("kind"), "id", "features")
    return first(model.userFactors, "user").unionByName(first(model.itemFactors, "item"))


@job("reco_auc_als")
def reco_auc_als(spark, sf_dir):
    return ops.mean_auc(auc_pairs(spark, sf_dir), ops.predict_model(model_of(spark, sf_dir)))


@job("reco_grid")
def reco_grid(spark, sf_dir):
    """AUC of eight settings, best first; the best one is trained on all rows and saved."""
    rows = ratings(spark, sf_dir)
    found = ops.grid(train_valid(spark, sf_dir)[0], auc_pairs(spark, sf_dir), (10, 50), (1.0, 0.0001), (1.0, 40.0), iterations=3)
    rank, reg, alpha, _ = found[0]
    ops.train_implicit(rows, rank, 3, reg, alpha).write().overwrite().save(fresh_dir(spark, "als-best"))
    return spark.createDataFrame(found, "rank int, reg double, alpha double, auc double")


@job("reco_user_topn")
def reco_user_topn(spark, sf_dir):
    """Ten best items, with names, for the ten users of the validation part with the most plays."""
    _, valid = train_valid(spark, sf_dir)
    chosen = valid.groupBy("user").agg(F.sum("rating").alias("n")).orderBy(F.desc("n"), "user").limit(10)
    best = ops.recommend(model_of(spark, sf_dir), chosen, 10)
    return ops.with_names(best, artists(spark, sf_dir))


@job("reco_item_users")
def reco_item_users(spark, sf_dir):
    top = settle(ops.most_listened(ratings(spark, sf_dir), 10), "most-listened")  # read more than once
    return ops.recommend_users(model_of(spark, sf_dir), top, 5)


@job("reco_similar_items")
def reco_similar_items(spark, sf_dir):
    """Items like the most played one."""
    query = ops.most_listened(ratings(spark, sf_dir), 1).first()["item"]
    return ops.with_names(ops.similar_items(model_of(spark, sf_dir), query, 10), artists(spark, sf_dir))


@job("reco_batch_users")
def reco_batch_users(spark, sf_dir):
    """Five items in one line for each of the hundred most active users."""
    active = (ratings(spark, sf_dir).groupBy("user").agg(F.sum("rating").alias("n"))
              .orderBy(F.desc("n"), "user").limit(100))
    best = ops.recommend(model_of(spark, sf_dir), settle(active, "most-active"), 5)  # read more than once
    return best.groupBy("user").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "item"))), lambda s: s["item"].cast("string")), ", ").alias("items"))


@job("reco_reload_equal", f"""WITH {SPLIT} SELECT count(*) AS pairs, CAST(0 AS BIGINT) AS different FROM parts
    WHERE part = 'valid' AND item IN (SELECT item FROM parts WHERE part = 'train')
      AND "user" IN (SELECT "user" FROM parts WHERE part = 'train')""")
def reco_reload_equal(spark, sf_dir):
    """A saved and loaded model predicts what the model in memory does."""
    train, valid = train_valid(spark, sf_dir)
    model, path = ops.train_implicit(train, iterations=2), fresh_dir(spark, "als-copy")
    model.write().overwrite().save(path)
    first = model.transform(valid).withColumnRenamed("prediction", "first")
    both = ALSModel.load(path).setColdStartStrategy("drop").transform(first)
    return both.agg(F.count(F.lit(1)).alias("pairs"),
                    F.count(F.when(F.col("first") != F.col("prediction"), 1)).alias("different"))
