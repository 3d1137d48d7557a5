"""Convolutional text classifier for toxicity, trained in numpy on a bounded sample.

Words are embedded by two hashed tables (two hashes, so that a word shares both
rows with hardly any other), filters of several widths slide over them, and the
largest response of each filter over the whole text feeds a logistic layer.
Thresholds are calibrated for each language on all labelled rows that the net
did not learn from; the language is recognised from the same hashed words, as
the table's own column is no input of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from panelwright.llm.bytescan import hashed_words, slices
from panelwright.sources.scratch import materialize

CUT = 0.7  # scores from here on count as toxic
SAMPLE = 6000  # most labelled documents that the training reads
SAMPLE_WORDS = 8192  # labelled documents with more words are left out of the training sample
BUCKETS = 1 << 16  # rows of each hashed table
WIDTH = 8  # numbers a row
WIDTHS = (1, 2, 3)  # words under a filter
FILTERS = 8  # filters of each width
SHRINK = 100  # toxic calibration texts at which a language's own threshold and that of all weigh the same
STEP, EDGE = 64, 4096  # the calibration counts logits in steps of 1 / STEP, at most EDGE steps from 0
_PAD = max(WIDTHS) - 1


def held_out(doc_id: Column) -> Column:
    """Whether a row takes no part in learning: crc32 of the id's text leaves 1 when divided by 3; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _rows_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(BUCKETS - 1)
    return (hashes & mask).astype(np.int32), ((hashes >> np.uint64(32)) & mask).astype(np.int32)


@dataclass
class ConvModel:
    """Weights; ``filters[w]`` has shape (w, 2 * WIDTH, FILTERS)."""

    tables: tuple[np.ndarray, np.ndarray]
    filters: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    out: np.ndarray
    bias: float
    languages: np.ndarray  # (BUCKETS, languages): log probabilities of hashed words
    cuts: np.ndarray  # the logit that counts as CUT, by language
    slope: float

    def _embed(self, first: np.ndarray, second: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedded words with ``_PAD`` zero rows before each text and at the end, and where each text begins."""
        counts = np.diff(rows)
        place = np.arange(len(first)) + _PAD * (np.repeat(np.arange(len(counts)), counts) + 1)
        x = np.zeros((len(first) + _PAD * (len(counts) + 1), 2 * WIDTH), np.float32)
        x[place, :WIDTH] = self.tables[0][first]
        x[place, WIDTH:] = self.tables[1][second]
        return x, rows[:-1] + _PAD * np.arange(len(counts))

    def pooled(self, first: np.ndarray, second: np.ndarray, rows: np.ndarray, where: bool = False):
        """Largest response of every filter in each text; with ``where``, also the windows that gave them."""
        x, begins = self._embed(first, second, rows)
        best, at = [], []
        for w in WIDTHS:
            n = len(x) - w + 1
            y = x[:n] @ self.filters[w][0]
            for tap in range(1, w):
                y += x[tap : tap + n] @ self.filters[w][tap]
            y = y[: len(x) - _PAD]
            top = np.maximum.reduceat(y, begins, axis=0)
            best.append(top + self.biases[w])
            if where:
                ends = np.r_[begins[1:], len(y)]
                at.append(np.array([b + y[b:e].argmax(0) for b, e in zip(begins, ends)]))
        pooled = np.concatenate(best, axis=1)
        return (pooled, x, at) if where else pooled

    def logits(self, first: np.ndarray, second: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.pooled(first, second, rows), 0) @ self.out + self.bias

    def language(self, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The likeliest language of each text; the first where a text has no words."""
        if self.languages.shape[1] < 2:
            return np.zeros(len(rows) - 1, np.int64)
        sums = np.zeros((len(rows) - 1, self.languages.shape[1]))
        full = np.flatnonzero(np.diff(rows) > 0)
        if len(full):
            sums[full] = np.add.reduceat(self.languages[first], rows[full], axis=0)
        return sums.argmax(1)

    def score(self, hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Probabilities in which each language's threshold lies at ``CUT``."""
        first, second = _rows_of(hashes)
        margin = self.slope * (self.logits(first, second, rows) - self.cuts[self.language(first, rows)])
        return 1 / (1 + np.exp(-np.clip(margin + np.log(CUT / (1 - CUT)), -30, 30)))


def _log_odds(buckets: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log ratio of the shares of toxic and other texts that hold a word of each bucket.

    The value is drawn towards zero by 1.64 standard errors, so that words seen once or twice say nothing.
    """
    counts = np.full((2, BUCKETS), 0.5)
    for b, y in zip(buckets, labels):
        counts[int(y), np.unique(b)] += 1
    totals = np.array([(labels == 0).sum(), (labels == 1).sum()]) + 1.0
    odds = np.log(counts[1] / totals[1]) - np.log(counts[0] / totals[0])
    return np.sign(odds) * np.maximum(0, np.abs(odds) - 1.64 * np.sqrt((1 / counts).sum(0)))


def train(texts: list[np.ndarray], labels: np.ndarray, languages: list[str | None], epochs: int = 6, rate: float = 0.02, seed: int = 7) -> ConvModel:
    """Fit on word hashes of labelled texts; the thresholds stay at logit 0.

    The first number of an embedding starts at the word's log odds in the
    sample, the others at small random values; Adam then trains all weights.
    Without both labels the model gives every text the sample's only label.
    """
    rng = np.random.default_rng(seed)
    firsts, seconds = zip(*[_rows_of(t) for t in texts]) if texts else ((), ())
    tables = tuple(rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32) for _ in range(2))
    learn = _learned(labels)
    for t, b in zip(tables, (firsts, seconds)):
        t[:, 0] = np.clip(_log_odds([b[i] for i in learn], labels[learn]) / 4, -1, 1)
    filters = {w: rng.normal(0, 0.1, (w, 2 * WIDTH, FILTERS)).astype(np.float32) for w in WIDTHS}
    for w in WIDTHS:
        filters[w][:, [0, WIDTH], :] += (np.abs(rng.normal(0.5, 0.2, FILTERS)) / w).astype(np.float32)
    biases = {w: np.full(FILTERS, -0.3, np.float32) for w in WIDTHS}
    out = np.full(len(WIDTHS) * FILTERS, 0.3, np.float32)
    names = sorted({x for x in languages if x})
    counts = np.full((BUCKETS, max(1, len(names))), 0.1)
    for b, x in zip(firsts, languages):
        if x:
            np.add.at(counts[:, names.index(x)], b, 1)
    model = ConvModel(tables, filters, biases, out, -1.0, np.log(counts / counts.sum(0)).astype(np.float32), np.zeros(max(1, len(names))), 1.0)
    if len(set(labels.tolist())) < 2:
        only = float(labels[0]) if len(labels) else 0.0
        model.out[:] = 0
        model.bias, model.cuts = 0.0, np.full(len(model.cuts), -4.0 if only else 4.0)
        return model
    _adam(model, [firsts[i] for i in learn], [seconds[i] for i in learn], labels[learn], epochs, rate, rng)
    return model


def _learned(labels: np.ndarray) -> np.ndarray:
    """Three quarters of each label to learn from, so that the others show how unseen texts score; all where that leaves too few."""
    number = np.empty(len(labels), np.int64)
    for y in (0, 1):
        own = labels == y
        number[own] = np.arange(own.sum())
    rest = number % 4 == 3
    if min((labels[rest] == 0).sum(), (labels[rest] == 1).sum()) < 8:
        return np.arange(len(labels))
    return np.flatnonzero(~rest)


def _batch(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])]


def _adam(model: ConvModel, firsts, seconds, labels, epochs: int, rate: float, rng) -> None:
    dense = {"out": model.out, **{f"f{w}": model.filters[w] for w in WIDTHS}, **{f"b{w}": model.biases[w] for w in WIDTHS}}
    first_moment, second_moment = ({k: np.zeros_like(v) for k, v in dense.items()} for _ in range(2))
    squares = [np.full((BUCKETS, 1), 1e-4, np.float32) for _ in range(2)]
    bias_m, bias_v, step = 0.0, 0.0, 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), 64):
            pick = order[lo : lo + 64]
            a, rows = _batch([firsts[i] for i in pick])
            b, _ = _batch([seconds[i] for i in pick])
            pooled, x, at = model.pooled(a, b, rows, where=True)
            active = np.maximum(pooled, 0)
            error = 1 / (1 + np.exp(-np.clip(active @ model.out + model.bias, -30, 30))) - labels[pick]
            error = (error / len(pick)).astype(np.float32)
            back = (error[:, None] * model.out) * (pooled > 0)
            grads = {"out": active.T @ error}
            wide = np.zeros_like(x)
            for k, w in enumerate(WIDTHS):
                g, pos = back[:, k * FILTERS : (k + 1) * FILTERS], at[k]
                grads[f"b{w}"] = g.sum(0)
                grad = np.zeros_like(model.filters[w])
                for tap in range(w):
                    seen = x[pos + tap]  # (texts, filters, numbers)
                    grad[tap] = np.einsum("tf,tfd->df", g, seen)
                    np.add.at(wide, (pos + tap).ravel(), (g[:, :, None] * model.filters[w][tap].T[None]).reshape(-1, 2 * WIDTH))
                grads[f"f{w}"] = grad
            step += 1
            for name, g in grads.items():
                first_moment[name] = 0.9 * first_moment[name] + 0.1 * g
                second_moment[name] = 0.999 * second_moment[name] + 0.001 * g * g
                dense[name] -= rate * (first_moment[name] / (1 - 0.9**step)) / (np.sqrt(second_moment[name] / (1 - 0.999**step)) + 1e-8)
            g = float(error.sum())
            bias_m, bias_v = 0.9 * bias_m + 0.1 * g, 0.999 * bias_v + 0.001 * g * g
            model.bias -= rate * (bias_m / (1 - 0.9**step)) / (bias_v / (1 - 0.999**step) + 1e-16) ** 0.5
            place = np.arange(len(a)) + _PAD * (np.repeat(np.arange(len(pick)), np.diff(rows)) + 1)
            for t, (ids, cols) in enumerate(((a, slice(0, WIDTH)), (b, slice(WIDTH, None)))):
                g = wide[place, cols]
                hit = np.flatnonzero(np.abs(g).sum(1))
                if len(hit):  # Adagrad for the few rows under a largest response
                    np.add.at(squares[t], ids[hit], (g[hit] ** 2).mean(1, keepdims=True))
                    np.add.at(model.tables[t], ids[hit], -rate * g[hit] / np.sqrt(squares[t][ids[hit]]))


def _histograms(docs: DataFrame, known: DataFrame, model: ConvModel, learned: np.ndarray) -> pd.DataFrame:
    """Number ``n`` of the rows of ``known`` (doc_id, toxic) by language, label, step of the logit, ``long`` (more words than the sample takes) and ``seen`` (learned from).

    Texts are scored whole where they lie; only ids and steps are shuffled. What
    reaches the driver is at most 2 * EDGE + 1 steps for each language and kind.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, learned))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, learned = shared.value
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                hashes, rows = hashed_words(part.column(1))
                first, second = _rows_of(hashes)
                step = np.clip(np.floor(model.logits(first, second, rows) * STEP), -EDGE, EDGE).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.language(first, rows), pa.int32()), pa.array(step), pa.array(np.diff(rows) > SAMPLE_WORDS),
                                                  pa.array(np.isin(part.column(0).to_numpy(), learned))], ["doc_id", "language", "step", "long", "seen"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    scored = rows.mapInArrow(run, "doc_id long, language int, step int, long boolean, seen boolean")
    return scored.join(known, "doc_id").groupBy("language", "toxic", "step", "long", "seen").agg(F.count(F.lit(1)).alias("n")).toPandas()


def _calibrate(model: ConvModel, counts: pd.DataFrame) -> None:
    """For each recognised language the logit with the best F1 over the labelled rows, and one slope for all.

    Rows that the net learned from score too well. The others of the same
    language, label and length stand for them, so all labelled rows weigh in
    with the language's own ratio of labels. The threshold of a language with
    few toxic rows is drawn to that of all.
    """
    group = counts.groupby(["language", "toxic", "long"])
    fresh = counts["n"].where(~counts["seen"], 0)
    others = fresh.groupby([counts["language"], counts["toxic"], counts["long"]]).transform("sum")
    rows = counts.assign(fresh=fresh, weight=fresh * group["n"].transform("sum") / others.clip(lower=1))[~counts["seen"]]
    if not len(rows):
        rows = counts.assign(fresh=counts["n"], weight=counts["n"].astype(float))
    width = len(model.cuts)

    def best(part: pd.DataFrame) -> float:
        steps = part.assign(bad=part["weight"] * (part["toxic"] == 1)).groupby("step")[["bad", "weight"]].sum().sort_index(ascending=False)
        step, bad, called = steps.index.to_numpy(), steps["bad"].cumsum().to_numpy(), steps["weight"].cumsum().to_numpy()
        k = int((2 * bad / (called + bad[-1])).argmax())
        # between the step and the next lower one that has rows
        return float((step[k] + step[k + 1] + 1) / 2 if k + 1 < len(step) else step[k] - STEP) / STEP

    whole = best(rows)
    for k in range(width):
        own = rows[rows["language"] == k]
        n = int(own.loc[own["toxic"] == 1, "fresh"].sum())
        if n and (own["toxic"] == 0).any():
            # few toxic texts place a threshold badly: it is drawn to that of all languages
            model.cuts[k] = (n * best(own) + SHRINK * whole) / (n + SHRINK)
        else:
            model.cuts[k] = whole
    spread = np.abs((rows["step"].to_numpy() + 0.5) / STEP - model.cuts[rows["language"].to_numpy()])
    order = np.argsort(spread)
    total = rows["fresh"].to_numpy()[order].cumsum()
    model.slope = float(4 / max(spread[order][np.searchsorted(total, total[-1] / 2)], 1e-6))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the documents that may be learned from, one row an id."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    known = known.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return materialize(known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi"), "labelled")


def _sample(docs: DataFrame, known: DataFrame, size: int) -> list[tuple[int, np.ndarray, int, str | None]]:
    """Id, word hashes, label and language of at most ``size`` labelled documents, half of them toxic if there are as many.

    Drawn by the hash of the id. The ids (at most ``size``) are broadcast; texts are hashed in the tasks.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    toxic = known.where("toxic = 1").orderBy(*order).limit(size // 2)
    clean = known.where("toxic = 0").orderBy(*order).limit(size - size // 2)
    ids = toxic.unionAll(clean).toPandas()
    chosen = F.broadcast(docs.sparkSession.createDataFrame(list(zip(ids["doc_id"].tolist(), ids["toxic"].tolist())), "doc_id long, toxic int"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"), F.col("lang").cast("string")).join(chosen, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                hashes, starts = hashed_words(part.column(1))
                keep = np.flatnonzero(np.diff(starts) <= SAMPLE_WORDS)
                words = pa.array([hashes[starts[i] : starts[i + 1]].tobytes() for i in keep], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep)), words, part.column(2).take(pa.array(keep)), part.column(3).take(pa.array(keep))],
                                                 ["doc_id", "words", "lang", "toxic"])

    got = rows.mapInArrow(run, "doc_id long, words binary, lang string, toxic int").dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    return [(int(i), np.frombuffer(w, np.uint64), int(y), x) for i, w, y, x in zip(got["doc_id"], got["words"], got["toxic"], got["lang"])]


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> ConvModel:
    """Train on a sample of at most ``size`` labelled documents that are not held out, then choose thresholds from all such documents."""
    known = _labelled(docs, labels)
    rows = _sample(docs, known, size)
    toxic = np.array([r[2] for r in rows], np.float32)
    model = train([r[1] for r in rows], toxic, [r[3] for r in rows])
    if len(set(toxic.tolist())) == 2:
        learned = _learned(toxic)
        # where the net learned from the whole sample, no row is left that could stand for another
        _calibrate(model, _histograms(docs, known, model, np.array([rows[i][0] for i in learned] if len(learned) < len(rows) else [], np.int64)))
    return model


def with_score(docs: DataFrame, model: ConvModel, text: str = "text", to: str = "score") -> DataFrame:
    """Adds the score of every whole text as column ``to`` and leaves the other columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names of the caller's columns may clash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(at)):
                part = batch.slice(lo, hi - lo)
                scores = pa.array(shared.value.score(*hashed_words(part.column(at))), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], [*part.schema.names, "score"])

    scored = plain.mapInArrow(run, StructType([*plain.schema.fields, StructField("score", DoubleType())]))
    return scored.toDF(*docs.columns, to)


def score_documents(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``CUT`` on) for every row.

    Null texts are read as empty; texts without words get the score of an empty
    text. An empty table gives no rows, an empty label table a model that calls
    nothing toxic. Repeated rows are scored alike, extra columns are ignored.
    """
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels, size))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """The rows that score below ``CUT``, with the columns of ``docs``."""
    scored = with_score(docs, fit(docs, labels, size), to="_toxicity")
    return scored.where(F.col("_toxicity") < CUT).drop("_toxicity")
