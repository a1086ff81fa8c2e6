"""Models on pair and document features, and samples to train them on."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

# Parts of the names of feature columns.
FEATURE_WORDS = ("jaro", "levenshtein", "length_ratio", "embedding")


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if any(w in c for w in FEATURE_WORDS)]


def _stages(features: list[str]) -> list:
    filled = [f"__i_{c}" for c in features]
    return [Imputer(inputCols=features, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="__raw"), MinMaxScaler(inputCol="__raw", outputCol="features")]


def classifiers(seed: int = 42) -> dict[str, tuple]:
    """Classifier and grid by name; boosted trees stand in for the gradient-boosting library that is not here."""
    gbt, forest, logistic = GBTClassifier(seed=seed, maxIter=10), RandomForestClassifier(seed=seed), LogisticRegression()
    return {
        "boosted": (gbt, ParamGridBuilder().addGrid(gbt.maxDepth, [3, 5]).build()),
        "forest": (forest, ParamGridBuilder().addGrid(forest.numTrees, [20, 50]).build()),
        "logistic": (logistic, ParamGridBuilder().addGrid(logistic.regParam, [0.01, 0.1]).build()),
    }


def train(df: DataFrame, features: list[str], label: str = "label", names: tuple[str, ...] = ("forest", "logistic"), folds: int = 5, seed: int = 42) -> tuple[str, PipelineModel, dict[str, float]]:
    """The best of the named kinds by cross-validated accuracy, fitted on all rows; and the accuracy of each."""
    data = df.where(F.col(label).isNotNull()).withColumn("label", F.col(label).cast("double"))
    prepared = Pipeline(stages=_stages(features)).fit(data)
    scored, fitted = {}, {}
    for name in names:
        model, grid = classifiers(seed)[name]
        found = CrossValidator(estimator=model, estimatorParamMaps=grid, evaluator=MulticlassClassificationEvaluator(metricName="accuracy"), numFolds=folds, seed=seed).fit(prepared.transform(data))
        scored[name], fitted[name] = max(found.avgMetrics), found.bestModel
    best = max(sorted(scored), key=lambda n: scored[n])
    return best, PipelineModel([prepared, fitted[best]]), scored


def scored(df: DataFrame, model: PipelineModel, name: str = "match_probability") -> DataFrame:
    out = model.transform(df)
    return out.withColumn(name, vector_to_array("probability")[1]).select(*df.columns, name)


def split_of(key, shares: dict[str, float], seed: int = 0) -> Column:
    """train, test, ... of a key by its hash, so all rows of a document fall together."""
    u = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(10_000)) / 10_000
    out, upto = F.lit(list(shares)[-1]), 1.0
    for name in list(shares)[-2::-1]:
        upto -= shares[list(shares)[list(shares).index(name) + 1]]
        out = F.when(u < upto, name).otherwise(out)
    return out


def balanced_by_pages(docs: DataFrame, label: str, pages: str, seed: int = 0) -> DataFrame:
    """Whole documents of the larger class up to the smaller one's pages, in the order of a hash."""
    from pyspark.sql import Window as W

    total = docs.groupBy(label).agg(F.sum(pages).alias("__t"))
    budget = total.agg(F.min("__t").alias("__b"))
    run = F.sum(pages).over(W.partitionBy(label).orderBy(F.xxhash64(*docs.columns, F.lit(seed))).rowsBetween(W.unboundedPreceding, 0))
    return docs.withColumn("__r", run).crossJoin(budget).where(F.col("__r") <= F.col("__b")).drop("__r", "__b")


def negatives_to(df: DataFrame, label: str, ratio: float, seed: int = 0) -> DataFrame:
    """All positives, and negatives by hash, so many for each positive on average."""
    counts = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    rate = F.least(F.lit(1.0), F.try_divide(F.col("p") * ratio, F.col("n").cast("double")))
    u = F.pmod(F.xxhash64(*df.columns, F.lit(seed)), F.lit(1_000_000)) / 1e6
    return df.crossJoin(F.broadcast(counts)).where((F.col(label) == 1) | (u < rate)).drop("p", "n")


def oversampled(df: DataFrame, label: str, times: float, seed: int = 42) -> DataFrame:
    return df.where(F.col(label) == 1).unionByName(df.where(F.col(label) == 0).sample(True, times, seed))
