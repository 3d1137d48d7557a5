"""Evaluation metrics and association tests as aggregations.

Ranking metrics work on score-grouped counts with running totals, so no task
sorts all scores.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwright.operators.profile import contingency, rows_from
from panelwright.operators.scale import exact_quantiles, running_totals, value_edges


def accuracy(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("accuracy"),
                               F.count(F.lit(1)).alias("n"))


def macro_accuracy(df: DataFrame, label: str, prediction: str, by: str) -> DataFrame:
    """Unweighted mean of the groups' accuracies."""
    return accuracy(df, label, prediction, [by]).agg(F.avg("accuracy").alias("macro_accuracy"), F.count(F.lit(1)).alias("n_groups"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where a denominator is 0."""
    cells = confusion(df, label, prediction)
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("hit")))).alias("s")).select("s.*")
    sums = sides.groupBy("cls").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    return sums.select(
        "cls", "support",
        F.coalesce(F.try_divide("hit", "predicted"), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide("hit", "support"), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hit"), F.col("support") + F.col("predicted")), F.lit(0.0)).alias("f1"))


def macro_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return class_report(df, label, prediction).agg(F.avg("f1").alias("macro_f1"))


def log_loss(label: Column, probability: Column, epsilon: float = 1e-15) -> Column:
    """Mean negative log-likelihood with clipped probabilities."""
    p = F.least(F.greatest(probability, F.lit(epsilon)), F.lit(1 - epsilon))
    return F.avg(-(label * F.log(p) + (1 - label) * F.log(1 - p)))


def score_totals(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score the positives, negatives and their running totals from below."""
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    freq = known.groupBy(score).agg(F.sum(F.col(label).cast("bigint")).alias("pos"),
                                    F.sum(1 - F.col(label).cast("bigint")).alias("neg"))
    return running_totals(freq, score, ["pos", "neg"], edges=value_edges(known, score))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve (Mann-Whitney; a tie counts one half)."""
    below = F.col("cum_neg") - F.col("neg")
    return score_totals(df, label, score).agg(F.try_divide(
        F.sum(F.col("pos") * (below + F.col("neg") / 2)), F.max("tot_pos").cast("double") * F.max("tot_neg")).alias("auc"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Sum over thresholds of the recall step times the precision."""
    tp = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")
    called = tp + F.col("tot_neg") - F.col("cum_neg") + F.col("neg")
    return score_totals(df, label, score).agg(
        F.try_divide(F.sum(F.col("pos") * tp / called), F.max("tot_pos")).alias("average_precision"))


def threshold_sweep(df: DataFrame, label: str, score: str, low: float = 0.05, high: float = 0.95, steps: int = 181) -> DataFrame:
    """Accuracy of ``score >= t`` for every cut-off t, from one histogram over the cut-offs."""
    cuts = [low + (high - low) * i / (steps - 1) for i in range(steps)]

    def cut(i: Column) -> Column:
        return F.lit(low) + F.lit(high - low) * i / F.lit(steps - 1)

    # arithmetic finds the number of passed cut-offs up to rounding; its neighbours settle it
    guess = F.least(F.greatest(F.floor((F.col("_s") - low) / ((high - low) / (steps - 1))) + 1, F.lit(0)), F.lit(steps))
    passed = (F.when((guess > 0) & (F.col("_s") < cut(guess - 1)), guess - 1)
              .when((guess < steps) & (F.col("_s") >= cut(guess)), guess + 1).otherwise(guess)).cast("int")
    hist = df.select(F.col(score).cast("double").alias("_s"), F.col(label).cast("bigint").alias("_y")).groupBy(
        passed.alias("_k")).agg(F.sum("_y").alias("_pos"), F.sum(1 - F.col("_y")).alias("_neg"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(i, c) for i, c in enumerate(cuts)], "_i int, threshold double")
    # a row that passes k cut-offs passes exactly the cut-offs 0 .. k-1; at most steps + 1 histogram rows
    slots = spark.range(steps + 1).select(F.col("id").cast("int").alias("_k")).join(F.broadcast(hist), "_k", "left").na.fill(0)
    w = Window.partitionBy(F.lit(0)).orderBy("_k")
    up_to = w.rowsBetween(Window.unboundedPreceding, 0)
    beyond = w.rowsBetween(1, Window.unboundedFollowing)
    marks = slots.select("_k", F.sum("_neg").over(up_to).alias("tn"), F.coalesce(F.sum("_pos").over(beyond), F.lit(0)).alias("tp"),
                         F.sum(F.col("_pos") + F.col("_neg")).over(Window.partitionBy(F.lit(0))).alias("n"))
    return grid.join(marks, F.col("_i") == F.col("_k")).select(
        "threshold", ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"), "n")


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The first cut-off with the highest accuracy."""
    return sweep.orderBy(F.col("accuracy").desc(), "threshold").limit(1)


def mse(actual: Column, predicted: Column) -> Column:
    return F.avg((actual - predicted) * (actual - predicted))


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(mse(actual, predicted))


def rmsle(actual: Column, predicted: Column) -> Column:
    """Root mean squared log error with both sides clipped at zero."""
    d = F.log1p(F.greatest(actual, F.lit(0.0))) - F.log1p(F.greatest(predicted, F.lit(0.0)))
    return F.sqrt(F.avg(d * d))


def chi2_tail(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution (regularised incomplete gamma)."""
    if x is None or dof <= 0 or not x > 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    lead = math.exp(-z + a * math.log(z) - math.lgamma(a))
    if z < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= z / k
            total += term
        return 1.0 - lead * total
    b, d = z + 1 - a, 0.0
    c, d = 1e300, 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return lead * h


def _chi2_p(statistic: Column | str, dof: Column | str) -> Column:
    """p-value of a test result; the frame it is applied to has one row per test."""
    def tail(x: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([chi2_tail(a, int(b)) for a, b in zip(x, d, strict=True)])

    return F.pandas_udf(tail, "double")(statistic, dof)


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Independence test: statistic, degrees of freedom, p-value; Yates' correction for one degree of freedom.

    Only observed cells are read: an empty one adds its expected count. All four gaps of
    a 2 x 2 table are equal, so its correction needs one gap and the sum of inverse
    expected counts, n (sum 1 / row) (sum 1 / col).
    """
    cells = contingency(df, a, b)
    rows = cells.groupBy(a).agg(F.first("row_total").alias("t")).agg(F.count(F.lit(1)).alias("n_a"), F.sum(1 / F.col("t")).alias("inv_a"))
    cols = cells.groupBy(b).agg(F.first("col_total").alias("t")).agg(F.count(F.lit(1)).alias("n_b"), F.sum(1 / F.col("t")).alias("inv_b"))
    gap = F.abs(F.col("observed") - F.col("expected"))
    stats = cells.agg(F.sum(gap * gap / F.col("expected")).alias("_gaps"), F.sum("expected").alias("_seen"), F.max(gap).alias("_gap"), F.sum("observed").alias("n"))
    one = stats.join(F.broadcast(rows)).join(F.broadcast(cols))  # three one-row frames
    fixed = F.col("_gap") - F.least(F.lit(0.5), F.col("_gap"))
    dof = (F.col("n_a") - 1) * (F.col("n_b") - 1)
    # an empty cell's gap is its expected count, so all of them add what the observed cells leave of n
    plain = F.col("_gaps") + F.col("n") - F.col("_seen")
    yates = fixed * fixed * F.col("n") * F.col("inv_a") * F.col("inv_b")
    out = one.select(F.when(dof == 1, yates).otherwise(plain).alias("chi2"), dof.alias("dof"), "n")
    return out.withColumn("p_value", _chi2_p("chi2", "dof"))


def mcnemar(df: DataFrame, label: str, first: str, second: str) -> DataFrame:
    """Paired test on the two kinds of disagreement, with continuity correction."""
    a, b = F.col(first) == F.col(label), F.col(second) == F.col(label)
    counts = df.agg(F.count_if(a & ~b).alias("only_first"), F.count_if(~a & b).alias("only_second"))
    gap = F.greatest(F.abs(F.col("only_first") - F.col("only_second")) - 1, F.lit(0))
    out = counts.withColumn("statistic", F.coalesce(F.try_divide(gap * gap, F.col("only_first") + F.col("only_second")), F.lit(0.0)))
    return out.withColumn("p_value", _chi2_p("statistic", F.lit(1)))


def jarque_bera(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Moment-based normality check per named expression: n, skewness, excess kurtosis, statistic, p-value."""
    rows = df.select(*[c.alias(n) for n, c in columns.items()])
    aggs = []
    for n in columns:
        aggs += [F.count(n).alias(f"{n}|n"), F.skewness(n).alias(f"{n}|s"), F.kurtosis(n).alias(f"{n}|k")]
    one = rows.agg(*aggs)
    out = rows_from(one, "transform", {
        n: {"n": F.col(f"`{n}|n`"), "skewness": F.col(f"`{n}|s`"), "kurtosis": F.col(f"`{n}|k`")} for n in columns})
    out = out.withColumn("statistic", F.col("n") / 6 * (F.col("skewness") ** 2 + F.col("kurtosis") ** 2 / 4))
    return out.withColumn("p_value", _chi2_p("statistic", F.lit(2)))


def quantile_quantile(df: DataFrame, column: str, points: int = 19) -> DataFrame:
    """Sample quantiles next to those of the normal distribution with the sample's mean and deviation."""
    probs = [i / (points + 1) for i in range(1, points + 1)]
    z = [NormalDist().inv_cdf(p) for p in probs]
    q = exact_quantiles(df, [column], probs)
    moments = df.agg(F.avg(column).alias("_m"), F.stddev_samp(column).alias("_s"))
    return q.join(F.broadcast(moments)).select(F.explode(F.array(*[
        F.struct(F.lit(p).alias("probability"), F.col(f"q{i}").alias("sample"), (F.col("_m") + F.lit(z[i]) * F.col("_s")).alias("normal"))
        for i, p in enumerate(probs)])).alias("r")).select("r.*")


def blend(scores: Sequence[str], weights: Sequence[float]) -> Column:
    """Weighted mean of scores with normalised weights."""
    total = float(sum(weights))
    out = F.lit(0.0)
    for s, w in zip(scores, weights, strict=True):
        out = out + F.col(s) * F.lit(w / total)
    return out


def blend_search(df: DataFrame, label: str, scores: Sequence[str], grid: Sequence[Sequence[float]], threshold: float = 0.5) -> DataFrame:
    """Accuracy of every weight vector of the grid, from one aggregation over the scores."""
    hit = [F.avg((((blend(scores, w) >= threshold).cast("int")) == F.col(label)).cast("int")).alias(f"a{i}") for i, w in enumerate(grid)]
    return df.agg(*hit).select(F.explode(F.array(*[
        F.struct(F.array(*[F.lit(float(v)) for v in w]).alias("weights"), F.col(f"a{i}").alias("accuracy"))
        for i, w in enumerate(grid)])).alias("r")).select("r.*")


def generalisation_gap(df: DataFrame, label: str, prediction: str, part: str, reference: str, tolerance: float = 0.01) -> DataFrame:
    """Accuracy per part and its difference from the reference part; flagged beyond the tolerance."""
    acc = accuracy(df, label, prediction, [part])
    base = acc.where(F.col(part) == reference).select(F.col("accuracy").alias("_ref"))
    gap = F.abs(F.col("accuracy") - F.col("_ref"))
    return acc.join(F.broadcast(base)).select(part, "accuracy", "n", gap.alias("gap"), (gap > tolerance).alias("flagged"))
