"""Model jobs on tables, one function per task; the fitting is pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import HashingTF, PCA, Tokenizer, UnivariateFeatureSelector
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heronlake.functions.hashing import mixed, share_of
from heronlake.functions.text import char_ngrams, java_split
from heronlake.functions.vectors import dot
from heronlake.operators import factors
from heronlake.operators.bigrams import HashedBigrams
from heronlake.operators.kmeans import SteadyKMeans
from heronlake.session import settle


def hash_split(df: DataFrame, id_col: str, share: float, seed: int = 0) -> DataFrame:
    """Adds `part`: a seeded hash of the id sends `share` of the rows to train, the rest to test."""
    return df.withColumn("part", F.when(share_of(mixed(F.col(id_col), seed), share), "train").otherwise("test"))


def as_features(df: DataFrame, array_col: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(array_col)))


# --- classification ---------------------------------------------------------------

def fit_multinomial(df: DataFrame, iterations: int = 100, reg: float = 0.0):
    return LogisticRegression(family="multinomial", maxIter=iterations, regParam=reg).fit(df)


def fit_svm(df: DataFrame, iterations: int = 100, reg: float = 0.01):
    """Linear support vector machine; rawPrediction holds the scores without a threshold."""
    return LinearSVC(maxIter=iterations, regParam=reg).fit(df)


def apply_svm(model, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("score", F.get(vector_to_array("rawPrediction"), F.lit(1)))


def linear_score(weights: Sequence[float], intercept: float, v: Column) -> Column:
    """Score of a linear model as a column function."""
    w = F.lit([float(x) for x in weights])
    return F.aggregate(F.zip_with(v, w, lambda a, b: a * b), F.lit(float(intercept)), lambda s, x: s + x)


def fit_with_params(df: DataFrame, overrides: dict[str, object]):
    """Logistic regression whose parameters are overridden by name at fit time."""
    lr = LogisticRegression(maxIter=10, regParam=0.01)
    return lr.fit(df, {lr.getParam(name): value for name, value in overrides.items()})


# --- regression -----------------------------------------------------------------------

def fit_linear(df: DataFrame, solver: str = "l-bfgs", iterations: int = 100):
    return LinearRegression(solver=solver, maxIter=iterations).fit(df)


def fit_elastic_net(df: DataFrame, iterations: int = 10, reg: float = 0.3, mix: float = 0.8):
    return LinearRegression(maxIter=iterations, regParam=reg, elasticNetParam=mix).fit(df)


# --- clusters, components, selection ------------------------------------------------------

def fit_kmeans(df: DataFrame, k: int, iterations: int = 20, seed: int = 1, features: str = "features", key: str | None = None):
    """Spark's model on centres that are the same for any partitioning of the rows; `key` tells equal points apart."""
    return SteadyKMeans(k, iterations, seed, features, key=key).fit(df)


def kmeans_cost(model, df: DataFrame, array_col: str) -> DataFrame:
    """(wssse, n): the squared distances of all rows to their nearest centre, added up."""
    centers = F.array(*[F.lit([float(x) for x in c]) for c in model.clusterCenters()])
    gap = F.zip_with(F.col(array_col), F.get(centers, F.col("prediction")), lambda a, b: a - b)
    return model.transform(df).agg(F.sum(dot(gap, gap)).alias("wssse"), F.count(F.lit(1)).alias("n"))


def fit_pca(df: DataFrame, k: int = 2):
    return PCA(k=k, inputCol="features", outputCol="components").fit(df)


def fit_chi_square(df: DataFrame, top: int = 3):
    selector = UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="selected",
                                         selectionMode="numTopFeatures")
    return selector.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(top).fit(df)


# --- text -----------------------------------------------------------------------------------

def bigram_features(df: DataFrame, col: str = "text", buckets: int = 1000) -> DataFrame:
    """Hashed counts of character pairs; the same on training and on scoring."""
    grams = df.withColumn("bigrams", char_ngrams(F.col(col)))
    return HashingTF(numFeatures=buckets, inputCol="bigrams", outputCol="features").transform(grams).drop("bigrams")


def bigram_cluster_stages(k: int, iterations: int = 10, buckets: int = 1000, seed: int = 1, key: str | None = None) -> Pipeline:
    """The text clusters as a pipeline that can be saved and applied to a stream."""
    counts = HashedBigrams(inputCol="text", outputCol="features", numFeatures=buckets)
    return Pipeline(stages=[counts, SteadyKMeans(k, iterations, seed, prediction="cluster", key=key)])


def text_classifier(buckets: int = 1000, iterations: int = 10, reg: float = 0.01) -> Pipeline:
    tf = HashingTF(numFeatures=buckets, inputCol="words", outputCol="features")
    return Pipeline(stages=[Tokenizer(inputCol="text", outputCol="words"), tf,
                            LogisticRegression(maxIter=iterations, regParam=reg)])


def line_tokens(lines: DataFrame, col: str = "value", out: str = "words") -> DataFrame:
    return lines.withColumn(out, java_split(F.col(col)))


# --- explicit ratings --------------------------------------------------------------------------

def fit_explicit(df: DataFrame, rank: int = 10, iterations: int = 10, reg: float = 0.01, seed: int = 1):
    return factors.fit(df, rank, iterations, reg, seed=seed)


# --- model selection ------------------------------------------------------------------------------

def folded(vector: Column, buckets: int, wide: int) -> Column:
    """Hashed counts in `buckets` from those in `wide`, a multiple of it: bucket i holds what hashes to i modulo buckets."""
    at = F.sequence(F.lit(0), F.lit(wide // buckets - 1))
    counts = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda i: F.aggregate(
        at, F.lit(0.0), lambda s, j: s + F.get(vector, (i + j * buckets).cast("int"))))
    return array_to_vector(counts)


def cross_validate(df: DataFrame, fold_col: str, buckets=(10, 100, 1000), regs=(0.1, 0.01), folds: int = 2,
                   iterations: int = 10) -> tuple[list[tuple], PipelineModel]:
    """((buckets, reg, mean area under ROC) for each setting, best model); the folds are a column.

    Texts are split and hashed once, with the largest number of buckets, and the counts of the others, which divide it, are
    folded from them; the numbers and the areas are those of separate pipelines. The stored rows serve all fits.
    """
    wide = max(buckets)
    if any(wide % b for b in buckets):
        raise ValueError("the numbers of buckets divide the largest")
    tokens = Tokenizer(inputCol="text", outputCol="words").transform(df.select("text", "label", fold_col))
    hashed = HashingTF(numFeatures=wide, inputCol="words", outputCol="wide").transform(tokens)
    dense = hashed.select("label", fold_col, "wide", vector_to_array("wide").alias("_wide"))
    columns = [F.col("wide") if b == wide else folded(F.col("_wide"), b, wide) for b in buckets]
    rows = settle(dense.select("label", fold_col, *[c.alias(f"f{b}") for b, c in zip(buckets, columns)]), "grid-features")
    found = []
    for b in buckets:
        for reg in regs:
            lr = LogisticRegression(maxIter=iterations, regParam=reg, featuresCol=f"f{b}")
            areas = []
            for fold in range(folds):
                model = lr.fit(rows.filter(F.col(fold_col) != fold))
                areas.append(BinaryClassificationEvaluator().evaluate(model.transform(rows.filter(F.col(fold_col) == fold))))
            found.append((b, reg, float(sum(areas) / folds)))
    best = max(found, key=lambda f: f[2])
    return found, text_classifier(best[0], iterations, best[1]).fit(df)


def train_validate(df: DataFrame, regs=(0.1, 0.01), mixes=(0.0, 0.5, 1.0), ratio: float = 0.8, seed: int = 1,
                   parallelism: int = 2) -> tuple[list[tuple], object]:
    """((reg, intercept, mix, rmse) for each setting, best model) on one split."""
    lr = LinearRegression(maxIter=10)
    maps = (ParamGridBuilder().addGrid(lr.regParam, list(regs)).addGrid(lr.fitIntercept, [False, True])
            .addGrid(lr.elasticNetParam, list(mixes)).build())
    model = TrainValidationSplit(estimator=lr, estimatorParamMaps=maps, evaluator=RegressionEvaluator(),
                                 trainRatio=ratio, seed=seed, parallelism=parallelism).fit(df)
    found = [(m[lr.regParam], m[lr.fitIntercept], m[lr.elasticNetParam], float(score))
             for m, score in zip(maps, model.validationMetrics)]
    return found, model.bestModel
