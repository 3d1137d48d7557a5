"""Target-distribution importance resampling with an Aho-Corasick dictionary.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z.
The distinct words of an Arrow batch form a dictionary whose payloads are each
word's CRC-32 and UTF-8 length; an Aho-Corasick automaton over it scans every
text of the batch and emits the payloads of its delimiter-bounded words in
order (leftmost-longest matches are whole words, as no dictionary word holds a
delimiter). A feature is a run of 1 to 3 words joined by one space; its CRC is
composed from the payloads (``crc(a + b) = M(len b) crc(a) xor crc(b)``, where
``M(L)`` shifts by L zero bytes), so no feature's bytes are hashed again. The
bucket is the CRC modulo ``BUCKETS``.

Bucket counts of the corpus and of the target (``benchmark``) are summed per
batch before the shuffle, which leaves a table of at most ``BUCKETS`` rows; its
gains are the only thing sent to the tasks. A document's weight is the sum of
the gains of its features; a Gumbel key of a hash of its id makes the top
scores a draw without replacement, ranked by range partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwright.llm.bytescan import slices
from panelwright.sources.scratch import materialize

BUCKETS = 10_000
MAX_GRAM = 3
MIN_WORDS = 20  # documents with fewer words are never drawn
DRAW_PERCENT = 5
SALT = "42:"  # fixed: prefix of the hashed doc_id
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_DELIMITER = bytes(c for c in range(128) if not (0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A)).decode("ascii")
_SPACE_CRC = zlib.crc32(b" ")
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(bool)
_shifts: dict[int, np.ndarray] = {}


def _shift_table(length: int) -> np.ndarray:
    """Byte tables (4 x 256) of the linear map that carries a CRC over ``length`` zero bytes."""
    table = _shifts.get(length)
    if table is None:
        zeros = bytes(length)
        base = zlib.crc32(zeros, 0)
        cols = np.array([zlib.crc32(zeros, 1 << k) ^ base for k in range(32)], np.uint32)
        table = np.stack([np.bitwise_xor.reduce(np.where(_BITS, cols[8 * j:8 * j + 8], np.uint32(0)), axis=1) for j in range(4)])
        if len(_shifts) > 4096:
            _shifts.clear()
        _shifts[length] = table
    return table


def combine(first: np.ndarray, second: np.ndarray, second_len: np.ndarray) -> np.ndarray:
    """CRC-32 of the concatenations, from the CRCs of both parts and the length of the second."""
    out = np.asarray(second, np.uint32).copy()
    first = np.asarray(first, np.uint32)
    for length in np.unique(second_len):
        at = second_len == length
        t, c = _shift_table(int(length)), first[at]
        out[at] ^= t[0][c & 255] ^ t[1][(c >> 8) & 255] ^ t[2][(c >> 16) & 255] ^ t[3][c >> 24]
    return out


def _words(lowered: str) -> list[str]:
    return [w for w in lowered.translate({ord(d): " " for d in _DELIMITER}).split(" ") if w]


def _batch_payloads(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(crc, byte length, text index) of every word of the texts in order, by one automaton scan of the batch.

    The dictionary holds the batch's distinct words; the texts are joined by a
    delimiter, so no match crosses from one text into the next.
    """
    lowered = [(t or "").translate(_UPPER) for t in texts]
    joined = "\x00".join(lowered)
    vocab = dict.fromkeys(_words(joined))
    if not vocab:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    crcs = np.zeros(len(vocab), np.uint32)
    lens = np.zeros(len(vocab), np.int64)
    automaton = ahocorasick.Automaton()
    for i, w in enumerate(vocab):
        raw = w.encode("utf-8")
        crcs[i], lens[i] = zlib.crc32(raw), len(raw)
        automaton.add_word(w, i)
    automaton.make_automaton()
    found = np.fromiter((x for match in automaton.iter_long(joined) for x in match), np.int64).reshape(-1, 2)
    starts = np.cumsum([0] + [len(t) + 1 for t in lowered[:-1]])
    owner = np.searchsorted(starts, found[:, 0], "right") - 1
    return crcs[found[:, 1]], lens[found[:, 1]], owner


def _payload_streams(texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
    """(crc, byte length) of each text's words in order."""
    crcs, lens, owner = _batch_payloads(texts)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1), "left")
    return [(crcs[a:b], lens[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def batch_features(crcs: np.ndarray, lens: np.ndarray, owner: np.ndarray, max_gram: int = MAX_GRAM) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 and text index of every run of 1 to ``max_gram`` words of one text, over a whole batch at once."""
    out, owners, run = [crcs], [owner], crcs
    for g in range(2, max_gram + 1):
        if len(crcs) < g:
            break
        spaced = combine(run[:-1], np.full(len(run) - 1, _SPACE_CRC, np.uint32), np.ones(len(run) - 1, np.int64))
        run = combine(spaced, crcs[g - 1:], lens[g - 1:])
        inside = owner[g - 1:] == owner[:len(owner) - g + 1]
        out.append(run[inside])
        owners.append(owner[:len(owner) - g + 1][inside])
        # runs that cross texts are dropped only after the next word is added, so ``run`` keeps its full length
    return np.concatenate(out), np.concatenate(owners)


def feature_crcs(crcs: np.ndarray, lens: np.ndarray, max_gram: int = MAX_GRAM) -> np.ndarray:
    """CRC-32 of every run of 1 to ``max_gram`` words joined by one space, repeats kept."""
    return batch_features(crcs, lens, np.zeros(len(crcs), np.int64), max_gram)[0]


def buckets_of(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of a single text's features (for tests and small uses)."""
    crcs, lens, _ = _batch_payloads([text])
    return (feature_crcs(crcs, lens) % np.uint32(buckets)).astype(np.int64)


def _slices(column: pa.Array) -> Iterator[list]:
    for lo, hi in slices(column):
        yield column.slice(lo, hi - lo).to_pylist()


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts per bucket, summed in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in _slices(batch.column(0)):
                feats, _ = batch_features(*_batch_payloads(part))
                total += np.bincount(feats % np.uint32(buckets), minlength=buckets)
        nonzero = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(nonzero, pa.int64()), pa.array(total[nonzero], pa.int64())], ["bucket", "n"])

    return (texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, features: DataFrame | None = None) -> list[float]:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of every bucket, as doubles; at most ``buckets`` numbers.

    ``features`` (from ``featurize`` of ``docs``) spares a second scan of the documents.
    """
    spark = docs.sparkSession
    ids = spark.range(buckets).withColumnRenamed("id", "bucket")
    s = (bucket_counts(docs, buckets) if features is None else stored_counts(features, buckets)).withColumnRenamed("n", "s")
    t = bucket_counts(target, buckets).withColumnRenamed("n", "t")
    # at most ``buckets`` rows, written once so that the totals and the gains read the same counts
    table = materialize(ids.join(s, "bucket", "left").join(t, "bucket", "left").fillna(0, ["s", "t"]), "importance-counts")
    totals = table.agg(F.sum("s").cast("double").alias("s_all"), F.sum("t").cast("double").alias("t_all"))
    d = lambda name: F.col(name).cast("double")
    ratio = ((d("t") + 1) * (d("s_all") + buckets)) / ((d("s") + 1) * (d("t_all") + buckets))
    rows = table.crossJoin(totals).select("bucket", F.floor(1000 * F.log(ratio)).cast("double").alias("gain")).collect()
    out = [0.0] * buckets
    for row in rows:
        out[row["bucket"]] = row["gain"]
    return out


def featurize(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, and the bucket of every feature of the text as little-endian 16-bit numbers; one automaton scan."""
    assert buckets <= 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                n = part.num_rows
                crcs, lens, owner = _batch_payloads(part.column(1).to_pylist())
                feats, at = batch_features(crcs, lens, owner)
                order = np.argsort(at, kind="stable")
                b = (feats[order] % np.uint32(buckets)).astype("<u2")
                cuts = np.searchsorted(at[order], np.arange(n + 1), "left")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.bincount(owner, minlength=n), pa.int64()),
                     pa.array([b[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])], pa.binary())], ["doc_id", "n_words", "buckets"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_words long, buckets binary")


def stored_counts(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) from the stored buckets of ``featurize``, summed in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            raw = batch.column(0).buffers()[2]
            if raw is not None:
                offsets = np.frombuffer(batch.column(0).buffers()[1], np.int32)[batch.column(0).offset:batch.column(0).offset + batch.num_rows + 1]
                data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]]
                total += np.bincount(data.view("<u2"), minlength=buckets)
        nonzero = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(nonzero, pa.int64()), pa.array(total[nonzero], pa.int64())], ["bucket", "n"])

    return features.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def weigh(features: DataFrame, gain: list[float]) -> DataFrame:
    """doc_id, n_words, n_features, weight (sum of the gains of a text's features; none: 0) from ``featurize``."""
    table = np.asarray(gain, np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + batch.num_rows + 1].astype(np.int64)
            raw = column.buffers()[2]
            data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
            counts = (offsets[1:] - offsets[:-1]) // 2
            b = data[offsets[0]:offsets[-1]].view("<u2").astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), counts)
            weights = np.bincount(owner, weights=table[b], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(np.rint(weights).astype(np.int64), pa.int64())],
                ["doc_id", "n_words", "n_features", "weight"])

    return features.select("doc_id", "n_words", "buckets").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))) with h the first 8 hex digits of sha256(SALT + doc_id)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(SALT), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def rank_top(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """Adds ``rank`` (1, 2, ... by score descending, then doc_id, nulls last) for the first floor(percent N / 100) eligible rows.

    The rows are cut into range partitions of the sort key and written once with
    their partition and place, as a second run of the cut may draw other bounds.
    Partitions are counted, the counts summed over the (few) partitions, and a
    row's rank is the rows of the partitions before it plus its place in its own:
    no task sees more than its range.
    """
    flagged = scored.withColumn("_eligible", eligible)
    n = flagged.where("_eligible").count()
    k = percent * n // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranged = flagged.where("_eligible").repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("_id", F.monotonically_increasing_id())
    ranged = materialize(ranged.withColumn("_part", F.shiftright("_id", 33)).withColumn("_pos", F.col("_id").bitwiseAND((1 << 33) - 1)), "importance-ranges")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_below"))
    rank = F.col("_below") + F.col("_pos") + 1
    drawn = ranged.join(before, "_part").select(*scored.columns, F.when(rank <= k, rank).cast("long").alias("rank"))
    rest = flagged.where(~F.col("_eligible")).select(*scored.columns, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, percent: int = DRAW_PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score, rank: one row per input row.

    Null texts have no features (weight 0); documents of fewer than
    ``min_words`` words are never drawn (rank null). Of the N others,
    floor(percent N / 100) are drawn by highest score, ties to the smaller
    doc_id; a null doc_id hashes as empty and sorts last. Repeated rows score
    alike and take consecutive ranks. An empty table gives no rows (an empty
    target counts as T = 0). Other columns are ignored.
    """
    features = materialize(featurize(docs, buckets), "importance-features")
    gain = gains(docs, target, buckets, features)
    weighed = materialize(weigh(features, gain), "importance-weights")
    scored = weighed.select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + gumbel(F.col("doc_id"))).cast("long").alias("score"))
    ranked = rank_top(scored, F.col("n_words") >= min_words, percent)
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")
