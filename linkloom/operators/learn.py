"""Learned dictionaries and models: token translations, gradient-boosted scorers in two stages, out of fold."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MIN_COUNT, MIN_CONF = 3, 0.4


def most_confident(counted: DataFrame, key: str, value: str, totals: DataFrame, min_count: int, min_conf: float) -> DataFrame:
    """The most frequent value of each key with support and confidence; ties by value."""
    rk = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), value))
    best = counted.withColumn("rk", rk).where("rk = 1").join(totals, key)
    return best.where((F.col("n") >= min_count) & (F.col("n") / F.col("total") >= min_conf)).select(key, value, "n", "total")


def learn_tokens(pairs: DataFrame, min_count: int = MIN_COUNT, min_conf: float = MIN_CONF) -> DataFrame:
    """(x, y, n, total) from pairs (source, target) of equally many words, aligned by place."""
    a, b = F.split("source", " "), F.split("target", " ")
    aligned = pairs.where(F.size(a) == F.size(b)).select(F.explode(F.arrays_zip(a.alias("x"), b.alias("y"))).alias("p")).select("p.x", "p.y")
    counted = aligned.where("x <> '' AND y <> ''").groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    return most_confident(counted, "x", "y", counted.groupBy("x").agg(F.sum("n").alias("total")), min_count, min_conf)


def learn_segments(pairs: DataFrame, min_count: int = MIN_COUNT, min_conf: float = MIN_CONF) -> DataFrame:
    """(x, y, n, total) from comma segments of source against the distinct ones of target; total counts x's occurrences."""
    seg = lambda c: F.filter(F.transform(F.split(c, ","), lambda s: F.trim(s)), lambda s: s != "")
    left = pairs.select(F.explode(seg("source")).alias("x"), F.array_distinct(seg("target")).alias("ys"))
    counted = left.select("x", F.explode("ys").alias("y")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    return most_confident(counted, "x", "y", left.groupBy("x").agg(F.count(F.lit(1)).alias("total")), min_count, min_conf)


# --- models -------------------------------------------------------------------------------------------------------


def hash_percent(key: Column, seed: int, n: int = 100) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(n))


def fold_of(key: Column, seed: int = 11, folds: int = 2) -> Column:
    return hash_percent(key, seed, folds).cast("int")


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows, the same on every run."""
    return df.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def sample_negatives(pairs: DataFrame, y: str, most: int, seed: int = 0) -> DataFrame:
    """All positives and at most ``most`` negatives."""
    key = F.xxhash64("i", "j", F.lit(seed))
    return pairs.where(F.col(y) == 1).unionByName(pairs.where(F.col(y) == 0).orderBy(key, "i", "j").limit(most))


def _ready(df: DataFrame, features: list[str]) -> DataFrame:
    """All feature columns as doubles; a missing column or value is 0."""
    return df.withColumns({f: (F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in df.columns else F.lit(0.0)) for f in features})


def fit_gbt(df: DataFrame, features: list[str], y: str, rounds: int = 20, depth: int = 5, step: float = 0.1, seed: int = 1, weight: str | None = None) -> PipelineModel:
    gbt = GBTClassifier(featuresCol="__f", labelCol=y, maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed, subsamplingRate=0.8, **({"weightCol": weight} if weight else {}))
    return PipelineModel([VectorAssembler(inputCols=features, outputCol="__f"), gbt.fit(_assembled(df, features))])


def fit_forest(df: DataFrame, features: list[str], y: str, trees: int = 30, depth: int = 8, seed: int = 1) -> PipelineModel:
    forest = RandomForestClassifier(featuresCol="__f", labelCol=y, numTrees=trees, maxDepth=depth, seed=seed)
    return PipelineModel([VectorAssembler(inputCols=features, outputCol="__f"), forest.fit(_assembled(df, features))])


def _assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="__f").transform(_ready(df, features))


def score_with(models: list[PipelineModel], df: DataFrame, features: list[str], out: str) -> DataFrame:
    """df with the mean probability of models."""
    scored, columns = _ready(df, features), df.columns
    for k, m in enumerate(models):
        scored = m.transform(scored).withColumn(f"__p{k}", F.get(vector_to_array("probability"), 1)).drop("rawPrediction", "probability", "prediction", "__f")
    mean = sum((F.col(f"__p{k}") for k in range(len(models))), F.lit(0.0)) / len(models)
    return scored.withColumn(out, mean).select(*columns, out)


def ensemble(df: DataFrame, features: list[str], y: str, seed: int = 1, **gbt) -> list[PipelineModel]:
    """A boosted and a bagged model, whose mean is the first-stage score."""
    return [fit_gbt(df, features, y, seed=seed, **gbt), fit_forest(df, features, y, seed=seed)]


def out_of_fold(df: DataFrame, features: list[str], y: str, fold: str, out: str, fit: Callable[[DataFrame], list[PipelineModel]]) -> tuple[DataFrame, list[PipelineModel]]:
    """Each fold's rows scored by the models fitted on the other fold; and all models, for new rows."""
    parts, every = [], []
    for k in (0, 1):
        models = fit(df.where(F.col(fold) == 1 - k))
        every += models
        parts.append(score_with(models, df.where(F.col(fold) == k), features, out))
    return reduce(DataFrame.unionByName, parts), every


def top_features(model: PipelineModel, features: list[str], n: int = 30) -> list[str]:
    weights = model.stages[-1].featureImportances.toArray()
    return [f for _, f in sorted(zip(-weights, features))][:n]
