"""Language identification by averaged hashed subword embeddings.

Every run of 1 to 4 bytes of the lower-cased letters picks a row of a hashed
embedding table; the average row of a text feeds a linear softmax. Both are
trained by stochastic gradient descent in numpy on a bounded sample. As average
and softmax are linear, a text is scored with the product of the two, one small
row a subword.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, BooleanType

from panelwright.llm.bytescan import LOWER, buffers, slices

UNKNOWN = "und"
SAMPLE = 4000  # most documents that the training reads, dealt evenly to the languages
BUCKETS = 1 << 14
WIDTH = 16
LENGTHS = (1, 2, 3, 4)  # bytes a subword
REJECTED = 0.02  # share of the calibration texts that the rejection threshold may turn away
SLICE = 1 << 17
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)
_LETTER = regex.compile(r"\p{L}")
#: bytes that belong to letters; all others count as one space
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def held_out(doc_id: Column) -> Column:
    """Whether a row takes no part in learning: crc32 of the id's text is divisible by 5; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def subwords(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each subword length, the hashed rows at every byte and the starts of texts; windows stay inside a text.

    The last byte positions of a text give windows that are cut off at its end.
    """
    data, offsets = buffers(column)
    # a space before each text, so that its first letter is seen as the start of a word and no text is empty
    n = len(data) + len(offsets) - 1
    begins = offsets[:-1] + np.arange(len(offsets) - 1)
    flat = np.full(n, 32, np.uint8)
    inner = np.ones(n, bool)
    inner[begins] = False
    flat[inner] = _LETTERS[LOWER[data]]
    ends = np.r_[begins[1:], n]
    wide = flat.astype(np.uint64) + np.uint64(1)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(max(LENGTHS)):
            shifted = np.zeros(n, np.uint64)
            if n > k:
                shifted[: n - k] = wide[k:]
            for j in range(1, k + 1):  # what lies beyond the text's end counts as nothing
                at = ends - j
                shifted[at[at >= begins]] = 0
            total = total * np.uint64(31) + shifted * _MULTIPLIERS[k]
            if k + 1 in LENGTHS:
                h = total ^ (total >> np.uint64(15))
                h = (h * np.uint64(0x2C1B3C6D)) ^ np.uint64(k * 0x1F123BB5)
                yield ((h >> np.uint64(13)) & np.uint64(BUCKETS - 1)).astype(np.int64), begins


def bucket_counts(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """The rows that each text's subwords pick, with how often."""
    parts = list(subwords(column))
    begins = parts[0][1]
    stacked = np.stack([p[0] for p in parts])
    edges = np.r_[begins, stacked.shape[1]]
    return [np.unique(stacked[:, a:b], return_counts=True) for a, b in zip(edges[:-1], edges[1:])]


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # (BUCKETS, languages): embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, column: pa.Array) -> np.ndarray:
        """One row a text, over all of its subwords."""
        sums, n = None, None
        for rows, begins in subwords(column):
            part = np.add.reduceat(self.weights[rows], begins, axis=0, dtype=np.float64)
            sums = part if sums is None else sums + part
            n = np.diff(np.r_[begins, len(rows)])
        z = (sums / (n * len(LENGTHS))[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, probability and whether that is too low to rely on; ``und`` for texts without a letter."""
        lettered = np.array([t is not None and _LETTER.search(t) is not None for t in column.to_pylist()], bool)
        if not self.languages:
            return [UNKNOWN] * len(column), np.zeros(len(column)), np.ones(len(column), bool)
        p = self.probabilities(column)
        best, score = p.argmax(1), p.max(1)
        named = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), lettered)]
        score = np.where(lettered, score, 0.0)
        return named, score, ~lettered | (score < self.reject_below)


def train(features: list[tuple[np.ndarray, np.ndarray]], labels: list[str], epochs: int = 8, least_steps: int = 600, rate: float = 0.5, seed: int = 11) -> LanguageModel:
    """Gradient descent over batches of 32, at least ``least_steps`` of them; every fifth text calibrates the temperature and the rejection threshold."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    y = np.array([languages.index(x) for x in labels])
    embeddings = rng.normal(0, 0.5, (BUCKETS, WIDTH)).astype(np.float32)
    softmax, bias = rng.normal(0, 0.5, (WIDTH, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)
    learn = np.flatnonzero(np.arange(len(y)) % 5 != 0) if len(y) >= 50 else np.arange(len(y))
    check = np.flatnonzero(np.arange(len(y)) % 5 == 0) if len(y) >= 50 else learn
    squares = np.full((BUCKETS, 1), 1e-6, np.float32)

    def average(i: int) -> np.ndarray:
        rows, n = features[i]
        return (n / n.sum()).astype(np.float32) @ embeddings[rows]

    for _ in range(max(epochs, -(-32 * least_steps // len(learn)))):
        order = rng.permutation(learn)
        for pick in np.split(order, range(32, len(order), 32)):
            x = np.stack([average(i) for i in pick])
            z = x @ softmax + bias
            z = np.exp(z - z.max(1, keepdims=True))
            error = z / z.sum(1, keepdims=True)
            error[np.arange(len(pick)), y[pick]] -= 1
            error /= len(pick)
            back = error @ softmax.T
            softmax -= rate * (x.T @ error)
            bias -= rate * error.sum(0)
            for i, g in zip(pick, back):
                rows, n = features[i]
                step = (n / n.sum()).astype(np.float32)[:, None] * g
                squares[rows] += (step**2).mean(1, keepdims=True)
                embeddings[rows] -= 0.1 * rate * step / np.sqrt(squares[rows])
    weights = embeddings @ softmax
    z = np.stack([(features[i][1] / features[i][1].sum()) @ weights[features[i][0]] for i in check]) + bias

    def loss(t: float) -> float:
        s = z / t
        return float((np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(check)), y[check]]).mean())

    temperature = min((2.0**k for k in np.arange(-4, 4.01, 0.25)), key=loss)
    s = np.exp(z / temperature - (z / temperature).max(1, keepdims=True))
    top = (s / s.sum(1, keepdims=True)).max(1)
    return LanguageModel(languages, weights.astype(np.float32), bias.astype(np.float64), float(temperature), float(np.quantile(top, REJECTED)))


def fit(docs: DataFrame, size: int = SAMPLE) -> LanguageModel:
    """Train on at most ``size`` documents that are not held out, as many of each language.

    A text is sent to the driver as its subword counts, at most ``BUCKETS`` numbers.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0))
    counts = known.groupBy("lang").count().orderBy("lang").toPandas()
    shares = [(lang, min(1.0, size / max(1, len(counts)) / n)) for lang, n in zip(counts["lang"], counts["count"])]
    if not shares:
        return train([], [])
    limits = known.sparkSession.createDataFrame([(lang, int(share * 2**31)) for lang, share in shares], "lang string, most long")
    chosen = known.where("lang is not null").join(F.broadcast(limits), "lang").where(F.shiftrightunsigned(F.xxhash64(F.lit(5), "doc_id"), 33) < F.col("most"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2), SLICE):
                part = batch.slice(lo, hi - lo)
                found = bucket_counts(part.column(2))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([r.astype(np.int32).tobytes() for r, _ in found], pa.binary()),
                     pa.array([n.astype(np.int32).tobytes() for _, n in found], pa.binary())], ["doc_id", "lang", "rows", "n"])

    got = chosen.select("doc_id", "lang", "text").mapInArrow(run, "doc_id long, lang string, rows binary, n binary").limit(2 * size).toPandas().sort_values(["doc_id", "rows"])
    return train([(np.frombuffer(r, np.int32), np.frombuffer(n, np.int32)) for r, n in zip(got["rows"], got["n"])], got["lang"].tolist())


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text", to: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """Adds language, score and whether the score is too low to rely on, from every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(at), SLICE):
                part = batch.slice(lo, hi - lo)
                named, score, rejected = shared.value.predict(part.column(at))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(named, pa.string()), pa.array(score), pa.array(rejected)],
                                                 [*part.schema.names, "lang_pred", "score", "rejected"])

    more = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]
    return plain.mapInArrow(run, StructType([*plain.schema.fields, *more])).toDF(*docs.columns, *to)


def identify(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for every row.

    ``und`` with score 0 for null texts and texts without a letter, and for
    every text where no language could be learned. An empty table gives no
    rows; repeated rows are predicted alike; extra columns are ignored.
    """
    found = with_language(docs.select("doc_id", "text"), fit(docs, size))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
