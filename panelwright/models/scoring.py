"""Batch scoring with a user-supplied model, symmetric scoring and model adapters."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

Loader = Callable[[], Callable[[pd.DataFrame], np.ndarray]]


def score_batches(df: DataFrame, ids: Sequence[str], inputs: Sequence[str], loader: Loader, n_classes: int) -> DataFrame:
    """Load a model once per task and score Arrow batches: ids, class probabilities and the best class.

    ``loader`` returns a function from a batch to an (n, classes) array of logits.
    """
    ids, inputs = list(ids), list(inputs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = None
        for pdf in batches:
            if pdf.empty:
                continue
            predict = predict or loader()
            logits = np.asarray(predict(pdf[inputs]), dtype=float).reshape(len(pdf), n_classes)
            shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
            prob = shifted / shifted.sum(axis=1, keepdims=True)
            yield pdf[ids].assign(probability=list(prob), prediction=prob.argmax(axis=1).astype("int32"))

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*ids).schema.fields)
    return df.select(*dict.fromkeys([*ids, *inputs])).mapInPandas(run, f"{types}, probability array<double>, prediction int")


def softmax(logits: Sequence[Column]) -> list[Column]:
    top = F.greatest(*logits)
    e = [F.exp(x - top) for x in logits]
    total = e[0]
    for x in e[1:]:
        total = total + x
    return [x / total for x in e]


def symmetric_scores(df: DataFrame, ids: Sequence[str], first: str, second: str,
                     scorer: Callable[[DataFrame, str, str], DataFrame]) -> DataFrame:
    """Average of the scores of (a, b) and of (b, a) with the two sides' classes flipped back.

    ``scorer`` returns ids and the columns ``p_first``, ``p_second``, ``p_tie``.
    """
    ids = list(ids)
    forward = scorer(df, first, second)
    back = scorer(df, second, first).select(*ids, F.col("p_second").alias("_f"), F.col("p_first").alias("_s"), F.col("p_tie").alias("_t"))
    return forward.join(back, ids).select(
        *ids, ((F.col("p_first") + F.col("_f")) / 2).alias("p_first"), ((F.col("p_second") + F.col("_s")) / 2).alias("p_second"),
        ((F.col("p_tie") + F.col("_t")) / 2).alias("p_tie"))


class ModelAdapter:
    """Wraps a foreign learner as fit / transform with ``probability`` and ``prediction``.

    ``fit_state`` runs Spark jobs on the training table and returns a bounded
    state; ``predict_proba`` maps a batch and the state to class-1 probabilities
    in the workers.
    """

    def __init__(self, inputs: Sequence[str], fit_state: Callable[[DataFrame], dict],
                 predict_proba: Callable[[pd.DataFrame, dict], np.ndarray], threshold: float = 0.5):
        self.inputs, self.fit_state, self.predict_proba, self.threshold = list(inputs), fit_state, predict_proba, threshold
        self.state: dict | None = None

    def fit(self, df: DataFrame) -> "ModelAdapter":
        self.state = self.fit_state(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.state is None:
            raise RuntimeError("fit the adapter before it is applied")
        inputs, state, predict = self.inputs, self.state, self.predict_proba

        def score(*columns: pd.Series) -> pd.Series:
            batch = pd.concat(columns, axis=1)
            batch.columns = inputs
            return pd.Series(np.asarray(predict(batch, state), dtype=float))

        probability = F.pandas_udf(score, "double")(*inputs)
        return df.withColumn("probability", probability).withColumn(
            "prediction", (F.col("probability") >= self.threshold).cast("int"))
