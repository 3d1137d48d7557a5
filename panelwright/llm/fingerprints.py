"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps modular prefix sums of a text's code points. They give the
hash of any span in constant time, so spans are compared without reading them
and longest common extensions are found by binary search. A fingerprint joins
the hash of the whole text with a sketch: the smallest span hash in each of
``SLOTS`` classes over all spans of ``SPAN`` code points. Shares of equal slots
estimate how alike two texts are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelwright.llm.ranges import long_table, range_of

PRIMES = (2147483647, 2147483629)  # of the two moduli; products fit in 64 bits
BASES = (1000003, 998244353 % 2147483629)
SPAN = 24  # code points a span of the sketch
SLOTS = 64
ROWS_A_BUCKET = 4096
MAX_BUCKETS = 1 << 16
_EMPTY = ".."

_powers: list[np.ndarray] = [np.ones(1, np.uint64) for _ in PRIMES]
_inverses: list[np.ndarray] = [np.ones(1, np.uint64) for _ in PRIMES]


def _table(tables: list[np.ndarray], k: int, n: int) -> np.ndarray:
    """The first ``n`` powers of base ``k`` or of its inverse, grown by doubling."""
    table, p = tables[k], np.uint64(PRIMES[k])
    base = BASES[k] if tables is _powers else pow(BASES[k], -1, PRIMES[k])
    while len(table) < n:
        table = np.r_[table, table * np.uint64(pow(base, len(table), PRIMES[k])) % p]
    tables[k] = table
    return table[:n]


class PrefixHash:
    """Modular prefix sums of a text: ``sums[k][i]`` covers its first ``i`` code points."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(points)
        self.sums = []
        for k, p in enumerate(PRIMES):
            terms = points * _table(_powers, k, self.n) % np.uint64(p)
            self.sums.append(np.r_[np.uint64(0), np.cumsum(terms)] % np.uint64(p))

    def _raw(self, k: int, start, length):
        """Span sums that still carry the power of their start."""
        p = np.uint64(PRIMES[k])
        return (self.sums[k][start + length] + p - self.sums[k][start]) % p

    def spans(self, start: np.ndarray, length: int) -> np.ndarray:
        """Hashes (first modulus above second) of spans of one length, comparable across texts."""
        out = [self._raw(k, start, length) * _table(_inverses, k, self.n + 1)[start] % np.uint64(p) for k, p in enumerate(PRIMES)]
        return (out[0] << np.uint64(31)) | out[1]

    def span(self, start: int, length: int) -> int:
        """Hash of one span."""
        return int(self.spans(np.array([start]), length)[0])

    def equal(self, start: int, other: PrefixHash, at: int, length: int) -> bool:
        """Whether two spans are equal; the powers of both starts are multiplied crosswise."""
        for k, p in enumerate(PRIMES):
            a = int(self._raw(k, start, length)) * pow(BASES[k], at, p)
            b = int(other._raw(k, at, length)) * pow(BASES[k], start, p)
            if (a - b) % p:
                return False
        return True

    def extension(self, start: int, other: PrefixHash, at: int) -> int:
        """Length of the longest common extension from two positions."""
        low, high = 0, min(self.n - start, other.n - at)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.equal(start, other, at, mid) else (low, mid - 1)
        return low


def fingerprint(hashed: PrefixHash) -> str:
    """16 hex digits of the whole text's hash and length, and two characters for each slot of the sketch.

    A text shorter than ``SPAN`` counts as one span; an empty text has empty slots only.
    """
    whole = hashed.span(0, hashed.n) ^ ((hashed.n * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
    slots = np.full(SLOTS, -1, np.int64)
    if hashed.n:
        length = min(SPAN, hashed.n)
        values = hashed.spans(np.arange(hashed.n - length + 1), length)
        with np.errstate(over="ignore"):
            values = values * np.uint64(0x9E3779B97F4A7C15)
            values ^= values >> np.uint64(32)
            values *= np.uint64(0xD6E8FEB86659FD93)
        slot, rest = (values >> np.uint64(58)).astype(np.int64), (values & np.uint64((1 << 58) - 1)).astype(np.int64)
        least = np.full(SLOTS, np.iinfo(np.int64).max)
        np.minimum.at(least, slot, rest)
        full = least < np.iinfo(np.int64).max
        slots[full] = (least[full] * 0x2545F4914F6CDD1D >> 40) & 255
    return f"{whole:016x}" + "".join(_EMPTY if s < 0 else f"{s:02x}" for s in slots.tolist())


def likeness(a: str, b: str) -> float:
    """Estimated share of common spans: equal slots, less those that agree by chance; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    x, y = ([s[i : i + 2] for i in range(16, 16 + 2 * SLOTS, 2)] for s in (a, b))
    used = sum(p != _EMPTY or q != _EMPTY for p, q in zip(x, y))
    same = sum(p == q != _EMPTY for p, q in zip(x, y))
    return max(0.0, (same / used - 1 / 256) / (1 - 1 / 256)) if used else 1.0


def with_following(docs: DataFrame) -> DataFrame:
    """Rows (bucket, follows, doc_id, text) in descending doc_id inside each bucket, dealt by bucket.

    ``doc_id`` ranges are buckets, cut by a mergeable sketch of the ids. The
    first row of each bucket comes once more at the end of the bucket before it
    (``follows``), so that every row finds its next row at hand: one shuffle of
    the texts and no window over all rows. Null ids come last.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))
    rows = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = rows.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(MAX_BUCKETS, max(4 * parts, n // ROWS_A_BUCKET), n // 2))
    sketch = rows.agg(F.percentile_approx("key", [i / buckets for i in range(1, buckets)] or [0.5], 4 * buckets + 1000)).first()[0]
    edges = sorted(set(sketch or []))
    bucket = range_of(F.col("key"), edges)
    tops = {r["b"]: r["top"] for r in rows.select(bucket.alias("b"), "key").groupBy("b").agg(F.max("key").alias("top")).collect()}
    used = sorted(tops)
    # at most one entry a bucket: the id that opens it, and the bucket that it also closes
    top = long_table([tops.get(b, 0) for b in range(len(edges) + 1)])
    before = {b: used[(i + 1) % len(used)] for i, b in enumerate(used)}
    goes = long_table([before.get(b, 0) for b in range(len(edges) + 1)])
    place = F.col("b") + 1
    ends = F.array(F.struct(F.col("b").alias("bucket"), F.lit(False).alias("follows")))
    both = F.concat(ends, F.array(F.struct(F.element_at(goes, place).cast("int").alias("bucket"), F.lit(True).alias("follows"))))
    dealt = rows.withColumn("b", bucket).withColumn("to", F.explode(F.when(F.col("key") == F.element_at(top, place), both).otherwise(ends)))
    dealt = dealt.select("to.bucket", "to.follows", "key", "doc_id", "text", F.xxhash64("text").alias("mark"))
    return dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "follows", F.desc("key"), "mark", "text").select("bucket", "follows", "doc_id", "text")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, and common_prefix: the length of the longest common
    extension of text and edited text from their starts. The edited text has the
    last half of the code points replaced by the first as many of the next
    document in descending doc_id; the first follows the last. Null texts are
    empty, null ids come last, rows that share an id are ordered by a hash of
    their text. A single row follows itself. An empty table gives no rows.
    """
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, common_prefix long")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the row whose next row has not come yet: bucket, id, text, its hash and fingerprint
        held: tuple | None = None
        for batch in batches:
            out: list[tuple] = []
            for bucket, follows, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None and bucket != held[0]:
                    held = None
                if follows and held is None:
                    continue  # only the first row behind a bucket is the next one
                hashed = PrefixHash(text)
                mark = fingerprint(hashed)
                if held is not None:
                    _, own_id, own_text, own, own_mark = held
                    half = len(own_text) // 2
                    edited = own_text[: len(own_text) - half] + text[:half]
                    other = PrefixHash(edited)
                    other_mark = fingerprint(other)
                    out.append((own_id, own.n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own_mark, other_mark,
                                likeness(own_mark, other_mark), likeness(own_mark, mark), own.extension(0, other, 0)))
                held = None if follows else (bucket, doc_id, text, hashed, mark)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _types())], names)

    return with_following(docs).mapInArrow(run, schema)


def _types() -> Sequence[pa.DataType]:
    return pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()
