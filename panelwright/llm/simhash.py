"""SimHash fingerprints, linked through the anchors of a covering code.

The code is the product of two binary Golay codes on bits 0-22 and 23-45. Each
half covers its 23-bit space perfectly with radius 3. If two fingerprints differ
in at most ``max_bits`` bits, the anchor nearest to the first lies within 3 of
its halves, and within 3 plus the differing bits of the second's halves. So a
fingerprint is copied to every anchor whose two distances exceed 3 by no more
than ``max_bits`` in all; any linked pair meets at an anchor, and all 64 bits
are compared there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from panelwright.llm.components import connected_components
from panelwright.sources.scratch import materialize

_POLY = 0b101011100011  # generator of the Golay code, degree 11
_RADIUS = 3
_LANES = np.array([[(b >> (7 - i)) & 1 for i in range(8)] for b in range(256)], np.uint8).view(np.uint64).ravel()
_BLOCK = 1024
_SMALL = 32  # anchors with more fingerprints are labelled block by block


def simhash(text: str | None, words: int = 3) -> int:
    """Majority bits of the XXH64 (seed 42) of all ``words``-word shingles; zero for a text without words."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    hash_of = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return hash_of(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    values = np.array([hash_of(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[words - 1 :].tolist())], ">u8")
    lanes = _LANES[values.view(np.uint8).reshape(-1, 8)]
    # eight 8-bit counters fill a 64-bit lane: 255 rows can be added before one overflows
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    counts = sums.view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(values)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, bits): one row per document, bits as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([simhash(t.as_py(), words) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(bits)], ["doc_id", "bits"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, bits long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words divided by the generator."""
    left = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        left ^= np.where((left >> bit) & 1, _POLY << (bit - 11), 0)
    return left


@lru_cache(maxsize=4)
def _patterns(excess: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Error patterns of up to 3 + ``excess`` bits by syndrome: starts, patterns, and their excess over the radius."""
    found = np.array([sum(1 << i for i in c) for w in range(_RADIUS + excess + 1) for c in combinations(range(23), w)], np.int64)
    weight = np.array([int(x).bit_count() for x in found])
    syndrome = _syndromes(found)
    order = np.lexsort((weight, syndrome))
    starts = np.searchsorted(syndrome[order], np.arange(2049))
    return starts, found[order], np.maximum(0, weight[order] - _RADIUS)


def anchors(bits: np.ndarray, max_bits: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """For fingerprints, (index, anchor) of every anchor within the covering radius plus ``max_bits``."""
    starts, found, over = _patterns(max_bits)
    halves = []
    for shift in (0, 23):
        word = ((bits.astype(np.uint64) >> np.uint64(shift)) & np.uint64((1 << 23) - 1)).astype(np.int64)
        s = _syndromes(word)
        n = starts[s + 1] - starts[s]
        row = np.repeat(np.arange(len(bits)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + starts[s][row]
        halves.append((n, word[row] ^ found[at], over[at]))
    (n1, c1, o1), (n2, c2, o2) = halves
    pairs = n1 * n2
    row = np.repeat(np.arange(len(bits)), pairs)
    k = np.arange(len(row)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    first = (np.cumsum(n1) - n1)[row] + k // n2[row]
    second = (np.cumsum(n2) - n2)[row] + k % n2[row]
    keep = o1[first] + o2[second] <= max_bits
    return row[keep], (c1[first[keep]] << 23) | c2[second[keep]]


def _stars(bits: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from members to the first of their component among the fingerprints of one anchor.

    The comparison runs in blocks; labels merge as it goes, so a cluster of any
    size gives one edge a member.
    """
    label = np.arange(len(bits))
    for lo in range(0, len(bits), _BLOCK):
        for at in range(lo, len(bits), _BLOCK):
            close = np.bitwise_count(bits[lo : lo + _BLOCK, None] ^ bits[None, at : at + _BLOCK]) <= max_bits
            for r in np.flatnonzero(close.any(1)):
                near = np.unique(label[at + np.flatnonzero(close[r])])
                own = label[lo + r]
                if len(near) > 1 or near[0] != own:
                    near = np.union1d(near, [own])
                    label[np.isin(label, near)] = near[0]
    moved = np.flatnonzero(label != np.arange(len(bits)))
    return bits[moved], bits[label[moved]]


def _pairs(group: np.ndarray, bits: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links inside each run of equal ``group``: all links of a small run, a star for each component of a large one."""
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[cuts, len(group)])
    left = np.repeat(np.where(sizes <= _SMALL, cuts + sizes, 0), sizes) - np.arange(len(group))
    found, k, at = [], 1, np.flatnonzero(left > 1)
    while len(at):
        close = at[np.bitwise_count(bits[at] ^ bits[at + k]) <= max_bits]
        found.append((bits[close + k], bits[close]))
        k += 1
        at = at[left[at] > k]
    for cut, size in zip(cuts[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist()):
        found.append(_stars(bits[cut : cut + size], max_bits))
    return np.concatenate([x for x, _ in found] or [bits[:0]]), np.concatenate([y for _, y in found] or [bits[:0]])


def anchor_links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``bits`` that span every group linked at ``max_bits`` or fewer."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                bits = batch.column(0).slice(lo, 512).to_numpy(zero_copy_only=False)
                row, anchor = anchors(bits.view(np.uint64), max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(bits[row])], ["anchor", "bits"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_anchor, kept_bits = np.empty(0, np.int64), np.empty(0, np.uint64)

        def edges(anchor: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
            a, b = _pairs(anchor, bits, max_bits)
            pairs = pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()
            return pa.RecordBatch.from_pandas(pairs, preserve_index=False)

        for batch in batches:
            anchor = np.r_[kept_anchor, batch.column(0).to_numpy()]
            bits = np.r_[kept_bits, batch.column(1).to_numpy().view(np.uint64)]
            if not len(anchor):
                continue
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if cut:
                yield edges(anchor[:cut], bits[:cut])
            kept_anchor, kept_bits = anchor[cut:], bits[cut:]
        if len(kept_anchor):
            yield edges(kept_anchor, kept_bits)

    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = prints.select("bits").mapInArrow(spread, "anchor long, bits long")
    return dealt.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id linked directly or through others).

    Nulls count as empty texts, and texts without words have fingerprint zero,
    which links like any other. Equal texts, repeated rows included, share a
    component. An empty table gives no rows; other columns are ignored. A
    component whose doc_ids are all null has a null component_id.
    """
    prints = materialize(with_fingerprint(docs, words), "prints")
    groups = materialize(prints.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "groups")
    labels = connected_components(anchor_links(groups, max_bits)).withColumnRenamed("node", "bits")
    whole = materialize(groups.join(labels, "bits", "left").select("bits", "first_id", F.coalesce("component", "bits").alias("component")), "labels")
    least = materialize(whole.groupBy("component").agg(F.min("first_id").alias("component_id")), "least")
    named = materialize(whole.join(least, "component").select("bits", "component_id"), "named")
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return prints.join(named, "bits").select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each SimHash group: that with the smallest doc_id (null last), then text hash, then first read.

    Groups are found between rows, not ids, so rows that share a doc_id but
    not a text keep their own groups. ``docs`` should read a table, so that
    row numbers are the same when a lost task is run again. Extra columns are
    carried along; an empty table gives no rows.
    """
    marked = docs.withColumn("_simhash_row", F.monotonically_increasing_id())
    found = near_duplicates(marked.select(F.col("_simhash_row").alias("doc_id"), "text"), words, max_bits)
    facts = marked.select(F.col("_simhash_row").alias("doc_id"), F.col("doc_id").cast("long").alias("_orig"), F.xxhash64("text").alias("_mark"))
    first = F.min(F.struct(F.col("_orig").isNull().alias("a"), F.col("_orig").alias("b"), F.col("_mark").alias("c"), F.col("doc_id").alias("d")))
    chosen = materialize(found.join(facts, "doc_id").groupBy("component_id").agg(first.alias("_first"))
                         .select(F.col("_first.d").alias("_simhash_row")), "simhash-kept")
    return marked.join(chosen, "_simhash_row", "left_semi").drop("_simhash_row")
