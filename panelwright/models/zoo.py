"""Model fitting, search and comparison on hash folds with Spark ML learners."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import IDF, HashingTF, NGram, Normalizer, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame, functions as F

from panelwright.features.steps import assemble
from panelwright.operators.metrics import accuracy, roc_auc
from panelwright.operators.splits import bootstrap_weight
from panelwright.sources.scratch import materialize

log = logging.getLogger(__name__)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Class weights n / (classes * class count); the class table has one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(F.sum("_n").alias("_t"), F.count(F.lit(1)).alias("_k"))
    table = counts.join(F.broadcast(totals)).select(label, (F.col("_t") / (F.col("_k") * F.col("_n"))).alias(out))
    return df.join(F.broadcast(table), label)


def grid_search(estimator: Estimator, grid: Sequence[dict], df: DataFrame, fold: str, evaluator: Evaluator, folds: int,
                parallelism: int = 2) -> CrossValidatorModel:
    """Cross-validated search over given folds; the grid's models fit in parallel jobs."""
    return CrossValidator(estimator=estimator, estimatorParamMaps=list(grid), evaluator=evaluator, numFolds=folds,
                          foldCol=fold, parallelism=parallelism).fit(df)


def search_table(model: CrossValidatorModel, df: DataFrame) -> DataFrame:
    """One row per grid point with its parameters as text and its mean metric."""
    rows = [(i, ", ".join(sorted(f"{p.name}={v}" for p, v in params.items())), float(m))
            for i, (params, m) in enumerate(zip(model.getEstimatorParamMaps(), model.avgMetrics, strict=True))]
    return df.sparkSession.createDataFrame(rows, "point int, params string, metric double")


def regression_rmse(label: str = "label") -> Evaluator:
    return RegressionEvaluator(labelCol=label, metricName="rmse")


def classification_accuracy(label: str = "label") -> Evaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


def f1_evaluator(label: str = "label") -> Evaluator:
    """F1 of the positive class."""
    return MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0)


def area_evaluator(label: str = "label") -> Evaluator:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")


def out_of_fold(df: DataFrame, fold: str, folds: int, fit: Callable[[DataFrame], Model], score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Predictions for every row from the model that did not see its fold."""
    out = None
    for k in range(folds):
        part = score(fit(df.where(F.col(fold) != k)).transform(df.where(F.col(fold) == k)))
        out = part if out is None else out.unionByName(part)
    return out


def bagged_scores(estimator: Estimator, train: DataFrame, rows: DataFrame, ids: Sequence[str], bags: int, score: Callable[[DataFrame], Column],
                  key: Sequence[str] | None = None, seed: int = 0) -> DataFrame:
    """Mean score of ``bags`` models, each fitted on a bootstrap resample given as row weights.

    The weights are Poisson counts from the hash of ``key``, so no resampled table is made.
    """
    models = []
    for b in range(bags):
        weighted = train.withColumn("_bag", bootstrap_weight(key or ids, b, seed).cast("double")).where("_bag > 0")
        models.append(estimator.copy({estimator.weightCol: "_bag"}).fit(weighted))
    out = rows.withColumn("_total", F.lit(0.0))
    base = out.columns
    for m in models:
        scored = m.transform(out)
        out = scored.withColumn("_total", F.col("_total") + score(scored)).select(*base)
    return out.select(*ids, (F.col("_total") / bags).alias("score"))


def positive_score(df: DataFrame) -> Column:
    """Probability of class 1 where the learner gives one, else its raw margin."""
    source = "probability" if "probability" in df.columns else "rawPrediction"
    return F.get(vector_to_array(source), F.lit(1))


def compare_models(models: Mapping[str, Estimator], df: DataFrame, ids: Sequence[str], fold: str, folds: int, label: str = "label") -> DataFrame:
    """Scoreboard: mean and deviation of fold accuracy and pooled AUC per model, best first; seconds go to the log."""
    rows = []
    for name, estimator in models.items():
        start = time.monotonic()
        scored = materialize(out_of_fold(df, fold, folds, estimator.fit, lambda s: s.select(
            *ids, fold, label, "prediction", positive_score(s).alias("score"))), f"oof-{name}")
        by_fold = accuracy(scored, label, "prediction", [fold]).agg(
            F.avg("accuracy").alias("m"), F.stddev_pop("accuracy").alias("s")).first()
        auc = roc_auc(scored.withColumn(label, F.col(label).cast("int")), label, "score").first()["auc"]
        rows.append((name, float(by_fold["m"]), float(by_fold["s"]), None if auc is None else float(auc)))
        log.info("%s: %.1f s", name, time.monotonic() - start)
    table = df.sparkSession.createDataFrame(rows, "model string, mean_accuracy double, std_accuracy double, auc double")
    return table.orderBy(F.col("mean_accuracy").desc(), "model")


def text_features(text: str, stop_words: Sequence[str], bigrams: bool = True, min_chars: int = 2, width: int = 1 << 18) -> Pipeline:
    """Tokens, optional bigrams and TF-IDF of all terms, hashed to ``width`` dimensions.

    Unigrams and bigrams share the hashed space through an SQL concat of both arrays.
    """
    from pyspark.ml.feature import SQLTransformer

    tok = RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"[\p{L}\p{N}_]+", gaps=False, minTokenLength=min_chars)
    stop = StopWordsRemover(inputCol="_tok", outputCol="_words", stopWords=list(stop_words))
    gram = NGram(n=2, inputCol="_words", outputCol="_bi")
    terms = SQLTransformer(statement=f"SELECT *, {'concat(_words, _bi)' if bigrams else '_words'} AS _terms FROM __THIS__")
    count = HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=width)
    idf, norm = IDF(inputCol="_tf", outputCol="_idf"), Normalizer(inputCol="_idf", outputCol="features", p=2.0)
    return Pipeline(stages=[tok, stop, gram, terms, count, idf, norm])


def text_pipeline(text: str, stop_words: Sequence[str], bigrams: bool = True, min_chars: int = 2, **svc) -> Pipeline:
    """Text features and a linear SVM."""
    return Pipeline(stages=[*text_features(text, stop_words, bigrams, min_chars).getStages(), LinearSVC(**svc)])


def feature_grid_search(features: Pipeline, learner: Estimator, grid: Sequence[dict], df: DataFrame, ids: Sequence[str], fold: str, folds: int,
                        evaluator: Evaluator, label: str = "label") -> DataFrame:
    """Mean metric per grid point of ``learner``; the features are fitted once per fold and written, not once per point.

    Leading stages that need no fit are applied to the whole table once and written, not once per fold.
    """
    scores, stages = np.zeros((folds, len(grid))), features.getStages()
    fixed = next((i for i, s in enumerate(stages) if isinstance(s, Estimator)), len(stages))
    if 0 < fixed < len(stages):
        inputs = [s.getInputCol() for s in stages[fixed:] if s.hasParam("inputCol")]
        made_once = PipelineModel(stages[:fixed]).transform(df)
        if len(inputs) == len(stages) - fixed:
            made_once = made_once.select(*dict.fromkeys([*ids, fold, label, *[c for c in inputs if c in made_once.columns]]))
        df, features = materialize(made_once, "fixed-features"), Pipeline(stages=stages[fixed:])
    for k in range(folds):
        model = features.fit(df.where(F.col(fold) != k))
        made = materialize(model.transform(df).select(*ids, fold, label, "features"), "fold-features")
        train, valid = made.where(F.col(fold) != k), made.where(F.col(fold) == k)
        scores[k] = [evaluator.evaluate(learner.fit(train, params).transform(valid)) for params in grid]
    rows = [(i, ", ".join(sorted(f"{p.name}={v}" for p, v in params.items())), float(m)) for i, (params, m) in enumerate(zip(grid, scores.mean(0), strict=True))]
    return df.sparkSession.createDataFrame(rows, "point int, params string, metric double")


def ridge_classifier(df: DataFrame, features: str, label: str, alpha: float) -> tuple[Model, Callable[[DataFrame], DataFrame]]:
    """Ridge on a +-1 target; the sign of the prediction is the class."""
    signed = df.withColumn("_y", F.when(F.col(label) > 0, 1.0).otherwise(-1.0))
    stats = signed.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("_y").alias("s")).first()
    # Spark divides the loss by n and scales the target, so the penalty is rescaled to alpha on the squared norm
    model = LinearRegression(featuresCol=features, labelCol="_y", regParam=alpha / stats["n"] * (stats["s"] or 1.0),
                             elasticNetParam=0.0, standardization=False, solver="normal").fit(signed)

    def predict(rows: DataFrame) -> DataFrame:
        return model.transform(rows).withColumnRenamed("prediction", "score").withColumn(
            "prediction", (F.col("score") > 0).cast("double"))

    return model, predict


def class_moments(df: DataFrame, array: str, label: str) -> tuple[list, dict]:
    """Count, sum and Gram matrix of an array column per class.

    Workers reduce their batches to p x p sums, which are added in the cluster;
    classes x p x p numbers reach the driver.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for pdf in batches:
            for cls, group in pdf.groupby("cls"):
                x = np.stack(group["v"].to_numpy()).astype(float)
                flat = np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
                sums[cls] = sums.get(cls, 0.0) + flat
        if sums:
            yield pd.DataFrame({"cls": list(sums), "m": list(sums.values())})

    kind = df.schema[label].dataType.simpleString()
    parts = df.select(F.col(label).alias("cls"), F.col(array).cast("array<double>").alias("v")).mapInPandas(partial, f"cls {kind}, m array<double>")
    added = parts.select("cls", F.posexplode("m").alias("i", "v")).groupBy("cls", "i").agg(F.sum("v").alias("v"))
    rows = added.groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("m")).orderBy("cls").collect()
    moments = {r["cls"]: np.array([e["v"] for e in r["m"]]) for r in rows}
    return list(moments), moments


def shrunk_discriminant(df: DataFrame, array: str, label: str, shrinkage: float = 0.1) -> Callable[[DataFrame], DataFrame]:
    """Linear discriminant with covariance shrunk towards a scaled identity; returns a scoring function."""
    classes, moments = class_moments(df, array, label)
    p = int(round((-1 + np.sqrt(1 + 4 * (len(moments[classes[0]]) - 1))) / 2))
    n = sum(m[0] for m in moments.values())
    means, pooled = [], np.zeros((p, p))
    for c in classes:
        m = moments[c]
        mu = m[1:1 + p] / m[0]
        means.append(mu)
        pooled += m[1 + p:].reshape(p, p) - m[0] * np.outer(mu, mu)
    pooled /= n
    cov = (1 - shrinkage) * pooled + shrinkage * np.trace(pooled) / p * np.eye(p)
    weights = np.linalg.solve(cov, np.array(means).T).T
    offsets = [float(-0.5 * w @ mu + np.log(moments[c][0] / n)) for w, mu, c in zip(weights, means, classes, strict=True)]

    def predict(rows: DataFrame) -> DataFrame:
        x = F.col(array).cast("array<double>")
        scores = [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in w]), lambda a, b: a * b), F.lit(o), lambda acc, v: acc + v)
                  for w, o in zip(weights, offsets, strict=True)]
        ranked = F.array_max(F.array(*[F.struct(s.alias("score"), F.lit(c).alias("cls")) for s, c in zip(scores, classes, strict=True)]))
        return rows.withColumn("_best", ranked).withColumn("prediction", F.col("_best.cls")).withColumn("score", F.col("_best.score")).drop("_best")

    return predict


def importances(model: Model, names: Sequence[str], df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most important features of a fitted tree model."""
    values = model.featureImportances.toArray()
    rows = sorted(((n, float(v)) for n, v in zip(names, values, strict=True)), key=lambda r: (-r[1], r[0]))[:k]
    return df.sparkSession.createDataFrame([(i + 1, n, v) for i, (n, v) in enumerate(rows)], "rank int, feature string, importance double")


def feature_drop_curve(df: DataFrame, names: Sequence[str], order: Sequence[str], estimator: Estimator, evaluator: Evaluator,
                       fold: str, folds: int, drops: Sequence[int]) -> DataFrame:
    """Cross-validated metric after leaving out the first d features of ``order`` (weakest first)."""
    rows = []
    for d in drops:
        kept = [n for n in names if n not in set(order[:d])]
        data = assemble(df, kept)
        scores = [evaluator.evaluate(estimator.fit(data.where(F.col(fold) != k)).transform(data.where(F.col(fold) == k))) for k in range(folds)]
        rows.append((int(d), len(kept), float(np.mean(scores)), float(np.std(scores))))
    return df.sparkSession.createDataFrame(rows, "n_dropped int, n_features int, mean_metric double, std_metric double")


def shapley_values(model: Model, df: DataFrame, ids: Sequence[str], names: Sequence[str], background: int = 100,
                   permutations: int = 4, seed: int = 0) -> DataFrame:
    """Sampled Shapley values (ids, feature, value) of a regression model on every row.

    Per row and permutation one background row is switched to the row's values,
    feature by feature; the changes of the prediction are averaged. The values of
    a row add up to its prediction minus the mean prediction of its background
    draws. The background is a hash sample of bounded size, sent along as one row.
    """
    from panelwright.operators.reshape import seeded_sample
    from panelwright.operators.scale import hash_key, hash_number

    p, rng = len(names), np.random.default_rng(seed)
    sample = seeded_sample(df, ids, background, seed).agg(F.collect_list(F.array(*[F.col(f"`{n}`").cast("double") for n in names])).alias("_bg"))
    steps = []
    for m in range(permutations):
        perm = [int(i) for i in rng.permutation(p)]
        for s in range(p + 1):
            on = set(perm[:s])
            pick = F.array(*[F.lit(i in on) for i in range(p)])
            steps.append(F.struct(F.lit(m).alias("m"), pick.alias("on"), F.lit(perm[s - 1] if s else -1).alias("gained"),
                                  F.lit(perm[s] if s < p else -1).alias("next")))
    base = df.join(F.broadcast(sample)).select(*ids, "_bg", F.array(*[F.col(f"`{n}`").cast("double") for n in names]).alias("_x"),
                                               F.explode(F.array(*steps)).alias("_s"))
    draw = hash_number(hash_key(*ids, F.col("_s.m"), seed=seed)) % F.size("_bg")
    mixed = base.withColumn("_b", F.get("_bg", draw.cast("int"))).withColumn(
        "_v", F.transform("_x", lambda x, i: F.when(F.get(F.col("_s.on"), i), x).otherwise(F.get("_b", i))))
    flat = mixed.select(*ids, "_s", *[F.get("_v", F.lit(i)).alias(n) for i, n in enumerate(names)])
    scored = model.transform(assemble(flat, names))
    parts = scored.select(*ids, F.explode(F.array(
        F.struct(F.col("_s.gained").alias("f"), F.col("prediction").alias("d")),
        F.struct(F.col("_s.next").alias("f"), (-F.col("prediction")).alias("d")))).alias("p")).where(F.col("p.f") >= 0)
    names_col = F.array(*[F.lit(n) for n in names])
    return parts.groupBy(*ids, F.col("p.f").alias("_f")).agg((F.sum("p.d") / permutations).alias("value")).select(
        *ids, F.get(names_col, F.col("_f")).alias("feature"), "value")


def mean_attribution(parts: Sequence[tuple[DataFrame, float]]) -> DataFrame:
    """Mean absolute attribution per feature, weighted over models."""
    total = sum(w for _, w in parts)
    out = None
    for values, w in parts:
        one = values.groupBy("feature").agg((F.avg(F.abs("value")) * (w / total)).alias("_v"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("feature").agg(F.sum("_v").alias("importance")).orderBy(F.col("importance").desc(), "feature")
