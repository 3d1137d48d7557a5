"""Packing along a space-filling curve.

Each document's hashed token counts are projected to a few dimensions and
placed on a Hilbert curve. Documents are dealt to ranges of the curve, sorted
inside them, and their tokens laid end to end; sequences are cut from that line
every ``LENGTH`` tokens, so neighbours on the curve share sequences and only the
end of the line needs padding. It is cut into powers of two, which need none.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelwright.llm.bytescan import slices
from panelwright.llm.ranges import long_table, range_of
from panelwright.sources.scratch import scratch_path

LENGTH = 2048  # tokens a sequence
END = 1  # id behind every document
VOCABULARY = "byte_bpe_50k"  # file name below the folder of public tokenizers
DIMENSIONS = 3
BITS = 10  # of each dimension on the curve
FEATURES = 256  # hashed token classes
SAMPLE = 64  # documents a range that the range borders are drawn from
ROWS_A_RANGE = 4096


@lru_cache(maxsize=2)
def _encoder(folder: str | None):
    """The byte-level vocabulary in its fast encoder; it gives the same ids as the vocabulary's JSON form."""
    import public_tokenizers
    import tiktoken

    path = f"{folder.rstrip('/')}/{VOCABULARY}.tiktoken" if folder else public_tokenizers.path(f"{VOCABULARY}.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})


def token_ids(text: str, folder: str | None = None) -> np.ndarray:
    """Ids of a text and the id that ends a document; the special token's string has its own id."""
    got = _encoder(folder).encode_to_numpy(text, allowed_special="all")
    return np.append(got, END).astype("<u2")


def _projection() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, FEATURES, 1 << 16), rng.normal(0, 1, (FEATURES, DIMENSIONS))


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows, dimensions), all rows at once.

    Works down from the highest bit: each level mirrors or swaps the axes below
    it, then the Gray code of the interleaved bits is decoded.
    """
    x = points.T.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(dims):
            on = (x[i] >> level) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def curve_keys(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys of documents from the square roots of their hashed token counts, at unit length."""
    table, axes = _projection()
    counts = np.stack([np.bincount(table[i], minlength=FEATURES) for i in ids])
    unit = np.sqrt(counts / counts.sum(1, keepdims=True))
    # coordinates of unit vectors: standard normal about a common mean; the range covers four deviations
    at = np.clip((unit @ axes + 4) / 8, 0, 1 - 1e-9)
    return hilbert_key((at * (1 << BITS)).astype(np.int64))


def with_tokens(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """(doc_id, text hash, curve, n, ids) for every row; ``ids`` holds 16-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # slices of bounded text bytes, so that a batch of long texts never stands whole in Python
            for lo, hi in slices(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                ids = [token_ids(t or "", folder) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(curve_keys(ids)), pa.array([len(i) for i in ids], pa.int64()),
                                                  pa.array([i.tobytes() for i in ids], pa.binary())], ["doc_id", "mark", "curve", "n", "ids"])
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, mark long, curve long, n long, ids binary")


def _binary_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and each row's offset in them, without copying."""
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    return (np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)), offsets


def _position() -> Column:
    """The curve key with 32 bits of the id's hash below it, so that documents of one curve point can be parted."""
    return F.shiftleft("curve", 32).bitwiseOR(F.shiftrightunsigned(F.xxhash64(F.lit(3), "doc_id", "mark"), 32))


def curve_borders(docs: DataFrame, rows: int, ranges: int, folder: str | None = None) -> list[int]:
    """Borders of about equal ranges of the curve, from a sample of ``SAMPLE`` documents a range.

    They deal the work and do not change the order of documents.
    """
    if ranges < 2:
        return []
    share = min(1.0, SAMPLE * ranges / max(1, rows))
    drawn = docs.where(F.shiftrightunsigned(F.xxhash64(F.lit(9), "doc_id"), 33) < int(share * 2**31))
    where = with_tokens(drawn, folder).select(_position().alias("p"))
    return sorted(set(where.agg(F.percentile_approx("p", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] or []))


def pack(docs: DataFrame, length: int = LENGTH, folder: str | None = None) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` tokens.

    doc_id, start (the document's ids before the piece), length, ids_crc32 (of
    the ids as little-endian unsigned 32-bit numbers), doc_tokens, sequence_id,
    offset, and padded_length of the sequence. Null texts are empty and consist
    of the end id. The last sequences have power-of-two lengths, so no sequence
    is padded unless ``length`` is less than the remaining tokens. Repeated rows
    are packed each; an empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.count(F.lit(1))).first()[0]
    borders = curve_borders(docs, rows, max(4 * parts, rows // ROWS_A_RANGE), folder)
    placed = with_tokens(docs, folder).withColumn("p", _position()).withColumn("range", range_of(F.col("p"), borders))
    dealt = placed.repartition(parts, "range").sortWithinPartitions("range", "p", "doc_id", "mark", "n")

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds each row's first token position in its range."""
        current, total = None, 0
        for batch in batches:
            begins = []
            for r, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if r != current:
                    current, total = r, 0
                begins.append(total)
                total += n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(begins, pa.int64())], ["range", "doc_id", "n", "ids", "begin"])

    path = scratch_path(spark, "laid")
    dealt.select("range", "doc_id", "n", "ids").mapInArrow(lay, "range int, doc_id long, n long, ids binary, begin long").write.option("compression", "zstd").parquet(path)
    laid = spark.read.schema("range int, doc_id long, n long, ids binary, begin long").parquet(path)
    # one row a range
    sums = {r["range"]: r["n"] for r in laid.groupBy("range").agg(F.sum("n").alias("n")).collect()}
    before = np.cumsum([0] + [sums.get(r, 0) for r in range(len(borders) + 1)])
    total = int(before[-1])
    at = F.col("begin") + F.element_at(long_table(before[:-1].tolist()), F.col("range") + 1)
    tail = total - total % length
    # the remainder falls into its powers of two, the largest first
    cuts, left = [tail], total - tail
    while left:
        cuts.append(cuts[-1] + (1 << (left.bit_length() - 1)))
        left -= 1 << (left.bit_length() - 1)
    ends = np.array(cuts[1:], np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            # ids are read in place from the Arrow buffers; only the small columns become Python numbers
            data, offsets = _binary_buffers(batch.column(2))
            for row, (doc_id, n, begin) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist())):
                wide, start = data[offsets[row]:offsets[row + 1]].view("<u2").astype("<u4"), 0
                while start < n:
                    place = begin + start
                    if place < tail:
                        number, first, size = place // length, place - place % length, length
                    else:
                        k = int(np.searchsorted(ends, place, "right"))
                        number, first, size = tail // length + k, cuts[k], cuts[k + 1] - cuts[k]
                    take = min(n - start, first + size - place)
                    out.append((doc_id, start, take, zlib.crc32(wide[start : start + take].tobytes()), n, number, place - first, size))
                    start += take
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 8, names)
        pa.default_memory_pool().release_unused()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length"]
    return laid.select("doc_id", "n", "ids", at.alias("begin")).mapInArrow(cut, ", ".join(f"{c} long" for c in names))
