"""Measures of extraction and clustering, as aggregations."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F


def ratio(a, b) -> Column:
    """a / b, or 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def prf_columns(tp: Column, fp: Column, fn: Column) -> list[Column]:
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return [p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1")]


def counts(pred: Column, gold: Column) -> list[Column]:
    return [F.count_if(pred & gold).alias("tp"), F.count_if(pred & ~gold).alias("fp"), F.count_if(~pred & gold).alias("fn"), F.count_if(~pred & ~gold).alias("tn")]


def _finish(rows: DataFrame, *keys: str) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return rows.select(*keys, "tp", "fp", "fn", "tn", *prf_columns(tp, fp, fn), ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"))


def binary_prf(df: DataFrame, pred: Column, gold: Column) -> DataFrame:
    return _finish(df.agg(*counts(pred, gold)))


def grouped_prf(df: DataFrame, pred: Column, gold: Column, group: str) -> DataFrame:
    """Measures overall and for each group in one pass; ``scope`` tells a null group from the whole."""
    sets = df.select(pred.alias("__p"), gold.alias("__g"), F.col(group).alias("grp")).groupingSets([[], ["grp"]], "grp")
    rows = sets.agg(*counts(F.col("__p"), F.col("__g")), F.grouping_id().alias("whole"))
    return _finish(rows.withColumn("scope", F.when(F.col("whole") == 1, "overall").otherwise("group")), "scope", "grp")


def set_prf(pred: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """Precision and recall of distinct keys."""
    both = pred.select(key).distinct().withColumn("p", F.lit(True)).join(gold.select(key).distinct().withColumn("g", F.lit(True)), key, "full")
    rows = both.agg(F.count_if(F.col("p") & F.col("g")).alias("tp"), F.count_if(F.col("g").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))
    return rows.select("tp", "fp", "fn", *prf_columns(F.col("tp"), F.col("fp"), F.col("fn")))


def confusion(df: DataFrame, gold: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(gold).alias("gold"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def field_metrics(df: DataFrame, fields: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Measures of each field (pred, gold as TRUE, FALSE or UNCLEAR), and of all pooled as "micro"."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("field"), (p == "TRUE").alias("p"), (g == "TRUE").alias("g")) for k, (p, g) in fields.items()])).alias("x")).select("x.*")
    sets = rows.groupingSets([[], ["field"]], "field").agg(*counts(F.col("p"), F.col("g")))
    return _finish(sets.withColumn("field", F.coalesce("field", F.lit("micro"))), "field")


def date_outcome(found: Column, truth: Column, match: Column) -> Column:
    """TP, TN, FP, FN or mismatch (which counts as both FN and FP) of a case's dates."""
    has_found, has_truth = F.size(found) > 0, F.size(truth) > 0
    return F.when(match, F.when(has_truth, "TP").otherwise("TN")).when(has_found & has_truth, "mismatch").when(has_found, "FP").when(has_truth, "FN").otherwise("TN")


def outcome_metrics(df: DataFrame, outcome: str, group: str | None = None) -> DataFrame:
    is_ = lambda *v: F.count_if(F.col(outcome).isin(*v))
    made = [is_("TP").alias("tp"), is_("FP", "mismatch").alias("fp"), is_("FN", "mismatch").alias("fn"), is_("TN").alias("tn")]
    return _finish(df.groupBy(group).agg(*made), group) if group else _finish(df.agg(*made))


def document_frequency(docs: DataFrame, id_col: str, values: Column) -> DataFrame:
    """``value, df``: in how many documents each value of an array occurs."""
    return docs.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(values)).alias("value")).groupBy("value").agg(F.count_distinct("id").alias("df"))


def frequent_values(docs: DataFrame, id_col: str, values: Column, share: float = 0.1) -> DataFrame:
    """Values in at least that share of documents (rounded down): too common to tell cases apart."""
    total = docs.agg(F.count("*").alias("n_docs"))
    return document_frequency(docs, id_col, values).crossJoin(F.broadcast(total)).where(F.col("df") >= F.floor(F.col("n_docs") * share)).select("value", "df")


def contingency(truth: DataFrame, test: DataFrame) -> DataFrame:
    """``gt, cluster, n`` and both sizes, from two tables ``id, gt`` and ``id, cluster``; sizes count all ids."""
    n = truth.join(test, "id").groupBy("gt", "cluster").agg(F.count("*").alias("n"))
    a = truth.groupBy("gt").agg(F.count("*").alias("gt_size"))
    b = test.groupBy("cluster").agg(F.count("*").alias("cluster_size"))
    return n.join(a, "gt").join(b, "cluster")


def best_match(truth: DataFrame, test: DataFrame) -> DataFrame:
    """For each true cluster the test cluster that holds most of it (ties: the least), with precision, recall and F1."""
    w = W.partitionBy("gt")
    rows = contingency(truth, test).withColumn("rank", F.row_number().over(w.orderBy(F.desc("n"), "cluster"))).withColumn("parts", F.count("*").over(w)).where("rank = 1")
    p, r = ratio(F.col("n"), F.col("cluster_size")), ratio(F.col("n"), F.col("gt_size"))
    return rows.select("gt", "cluster", "n", "gt_size", "cluster_size", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"), (F.col("parts") - 1).alias("splits"), (F.col("cluster_size") - F.col("n")).alias("merged"))


def best_match_summary(matches: DataFrame) -> DataFrame:
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0)).alias(c)
    return matches.agg(mean("precision"), mean("recall"), mean("f1"), F.count("*").alias("clusters"), F.count_if(F.col("splits") > 0).alias("with_splits"), F.count_if(F.col("merged") > 0).alias("with_merges"))


def bcubed(truth: DataFrame, test: DataFrame) -> DataFrame:
    n, total = F.col("n"), F.sum("n").cast("double")
    rows = contingency(truth, test).agg((F.sum(n * n / F.col("cluster_size")) / total).alias("p"), (F.sum(n * n / F.col("gt_size")) / total).alias("r"))
    p, r = F.coalesce("p", F.lit(0.0)), F.coalesce("r", F.lit(0.0))
    return rows.select(p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"))


def adjusted_rand(truth: DataFrame, test: DataFrame) -> DataFrame:
    """Adjusted Rand index of the ids in both; 0 for fewer than two, 1 for equal partitions."""
    pairs = lambda x: x * (x - 1) / 2.0
    both = truth.join(test, "id")
    cells = both.groupBy("gt", "cluster").count().agg(F.sum(pairs(F.col("count"))).alias("s"), F.sum("count").alias("n"))
    a = both.groupBy("gt").count().agg(F.sum(pairs(F.col("count"))).alias("a"))
    b = both.groupBy("cluster").count().agg(F.sum(pairs(F.col("count"))).alias("b"))
    rows = cells.crossJoin(a).crossJoin(b)  # one row each
    expected = F.try_divide(F.col("a") * F.col("b"), pairs(F.col("n")))
    value = F.try_divide(F.col("s") - expected, (F.col("a") + F.col("b")) / 2 - expected)
    return rows.select(F.when(F.coalesce("n", F.lit(0)) < 2, 0.0).otherwise(F.coalesce(value, F.lit(1.0))).alias("ari"))


def quality_bands(matches: DataFrame) -> DataFrame:
    f1 = F.col("f1")
    return matches.agg(F.count_if(f1 == 1).alias("perfect"), F.count_if((f1 >= 0.8) & (f1 < 1)).alias("good"), F.count_if((f1 >= 0.5) & (f1 < 0.8)).alias("fair"), F.count_if(f1 < 0.5).alias("poor"))


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    n = F.col("count")
    return clusters.groupBy("cluster").count().agg(F.count("*").alias("clusters"), F.count_if(n == 1).alias("singletons"), F.count_if(n > 1).alias("multiple"), F.max(n).alias("largest"), F.avg(n).alias("mean"))


def describe(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Mean, median, spread and quartiles (linear); the spread of a single value is 0."""
    v = F.col(value).cast("double")
    q = F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    rows = df.groupBy(*keys).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), q.alias("q"))
    return rows.select(*keys, "n", "mean", "std", "min", "max", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), (F.col("q")[2] - F.col("q")[0]).alias("iqr"))


def bootstrap_ci(df: DataFrame, value: str, *keys: str, samples: int = 1000, confidence: float = 0.95, seed: int = 42) -> DataFrame:
    """Percentile interval of the mean, by resampling each group's values (a group is a set of scores, one a cluster)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.sort(pdf[value].dropna().to_numpy(float))
        head = [pdf[k].iloc[0] for k in keys]
        if not len(x):
            return pd.DataFrame([[*head, 0.0, 0.0, 0.0]], columns=[*keys, "mean", "lower", "upper"])
        rng = np.random.default_rng(seed)
        means = np.array([x[rng.integers(0, len(x), len(x))].mean() for _ in range(samples)])
        lo, hi = np.quantile(means, [(1 - confidence) / 2, (1 + confidence) / 2])
        return pd.DataFrame([[*head, x.mean(), lo, hi]], columns=[*keys, "mean", "lower", "upper"])

    schema = ", ".join([f"{k} {dict(df.dtypes)[k]}" for k in keys] + ["mean double", "lower double", "upper double"])
    return df.select(*keys, F.col(value).cast("double").alias(value)).groupBy(*keys).applyInPandas(run, schema)


def poststratified(df: DataFrame, stratum: str, value: Column, shares: DataFrame) -> DataFrame:
    """Mean of each stratum weighted by its share of the corpus (``stratum, share``)."""
    means = df.groupBy(stratum).agg(F.avg(value).alias("m"))
    return means.join(F.broadcast(shares), stratum).agg((F.sum(F.col("m") * F.col("share")) / F.sum("share")).alias("value"))


def token_costs(usage: DataFrame, group: str, price_in: float = 0.40, price_out: float = 1.60) -> DataFrame:
    """Tokens and cost (prices a million) of each group and in all."""
    sets = usage.groupingSets([[], [group]], group).agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.count("*").alias("calls"), F.grouping_id().alias("whole"))
    cost = (F.col("tokens_in") * price_in + F.col("tokens_out") * price_out) / 1e6
    return sets.select(F.when(F.col("whole") == 1, "total").otherwise(F.col(group).cast("string")).alias("scope"), "tokens_in", "tokens_out", "calls", cost.alias("cost"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("copies", F.count("*").over(W.partitionBy(key))).where("copies > 1")


def most_common(df: DataFrame, value: str, n: int = 50) -> DataFrame:
    return df.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(n)


def ranked_methods(scores: DataFrame) -> DataFrame:
    """Mean scores of each method by category side by side, and ``mean_f1`` over all; the best first, then by name."""
    wide = scores.groupBy("method").pivot("category").agg(F.avg("f1"))
    return wide.join(scores.groupBy("method").agg(F.avg("f1").alias("mean_f1")), "method").orderBy(F.desc("mean_f1"), "method")
