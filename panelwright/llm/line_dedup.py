"""Removal of repeated and near-repeated lines by an exact set-similarity join.

A line is the set of its lower-cased words. Words are ordered by rarity, counted
over the whole corpus in a table of fixed width; any fixed order keeps the join
exact, rare words first keep it small. Two lines with a Jaccard similarity of
0.8 or more share a word in their prefixes. The join runs in two steps. First
each line sends a short record to its prefix words, where a length, a positional
and a word-histogram filter tell which lines have a possible partner at all.
Then only these lines send their whole word sets, and pairs are verified where
they meet. No step emits pairs: the first gives the lines with a partner, the
second the later lines of verified pairs. Repeats of an equal set go as well.

Words are told apart by 42-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelwright.llm.bytescan import BLANK_SEPARATED, LOWER, buffers, mix, slices, span_hashes, word_bounds
from panelwright.sources.scratch import materialize

SLICE = 1 << 17  # text bytes at a time: at most 2**16 lines with words
TABLE_BITS = 22  # width of the word count table
STRIPE_BITS = 16  # its rows are summed in stripes
HASH_BITS = 42
SMALLEST = 4  # words from which a line can match another set of words
NARROW = 128  # words up to which a histogram of 32 classes is enough
WIDE = 128  # classes of the histogram of larger lines
POSTINGS = 400_000  # records that a task gathers before it sends them
SPREAD = 8  # groups of prefix words a shuffle partition
_HASH = np.uint64((1 << HASH_BITS) - 1)
_LAST = (1 << 63) - 1


class _Lines:
    """The word sets of all lines with words in a slice of texts."""

    def __init__(self, column: pa.Array, classes: np.ndarray | None = None):
        data, offsets = buffers(column)
        data = LOWER[data]
        starts, ends, _ = word_bounds(data, offsets, BLANK_SEPARATED)
        breaks = np.flatnonzero(data == 10)
        row = np.searchsorted(offsets, starts, "right") - 1
        number = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets)[row]  # line of the word in its text
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
        line = np.cumsum(fresh) - 1
        self.row, self.number = row[fresh], number[fresh]
        hashes = span_hashes(data, starts, ends) & _HASH
        kind = np.zeros(len(hashes), np.uint64) if classes is None else classes[(hashes & np.uint64(len(classes) - 1)).astype(np.int64)].astype(np.uint64)
        if len(self.row) <= 1 << 16:
            keys = np.sort((line.astype(np.uint64) << np.uint64(48)) | (kind << np.uint64(HASH_BITS)) | hashes)
            line, hashes = (keys >> np.uint64(48)).astype(np.int64), keys & _HASH
        else:  # one very long text
            order = np.lexsort((hashes, kind, line))
            line, hashes = line[order], hashes[order]
        once = np.ones(len(hashes), bool)
        once[1:] = (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1])
        #: words of all lines in order of rarity, the line of each, and each line's first word
        self.words, self.line = hashes[once], line[once]
        self.first = np.searchsorted(self.line, np.arange(len(self.row) + 1))
        self.size = np.diff(self.first)

    def sets(self) -> np.ndarray:
        """A hash of each line's word set."""
        if not len(self.size):
            return np.empty(0, np.int64)
        with np.errstate(over="ignore"):
            return mix(np.add.reduceat(mix(self.words + np.uint64(1)), self.first[:-1]) + self.size.astype(np.uint64)).view(np.int64)

    def histogram(self, lines: np.ndarray, classes: int) -> np.ndarray:
        """Words of the given lines by the leading bits of their hash, at most 15 a class."""
        at = np.full(len(self.size), -1)
        at[lines] = np.arange(len(lines))
        own = at[self.line]
        used = own >= 0
        bucket = (self.words[used] >> np.uint64(HASH_BITS - classes.bit_length() + 1)).astype(np.int64)
        counts = np.bincount(own[used] * classes + bucket, minlength=len(lines) * classes)
        return np.minimum(counts, 15).astype(np.uint8).reshape(len(lines), classes)


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id (null last), a hash of the text, and the text: what names a document here."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("string").alias("text"))


def _scan(docs: DataFrame) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """All documents (doc_id, mark, n_lines with words), all such lines (doc_id, mark, line, set), and the rarity class of every row of the word count table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << TABLE_BITS, np.uint32)
        for batch in batches:
            for lo, hi in slices(batch.column(2), SLICE):
                part = batch.slice(lo, hi - lo)
                lines = _Lines(part.column(2))
                np.add.at(counts, (lines.words & np.uint64(len(counts) - 1)).astype(np.int64), 1)
                at = pa.array(np.r_[lines.row, np.arange(hi - lo)])
                number = np.r_[lines.number, np.bincount(lines.row, minlength=hi - lo)]
                sets = pa.array(np.r_[lines.sets(), np.zeros(hi - lo, np.int64)], mask=np.r_[np.zeros(len(lines.row), bool), np.ones(hi - lo, bool)])
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(number, pa.int32()), sets,
                                                  pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.binary())], names)
        stripes = counts.reshape(-1, 1 << STRIPE_BITS)
        used = np.flatnonzero(stripes.any(1))
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.int32()), pa.nulls(len(used), pa.int64()),
            pa.array(used, pa.int32()), pa.array([zlib.compress(stripes[k].tobytes(), 1) for k in used], pa.binary())], names)

    names = ["doc_id", "mark", "line", "set", "stripe", "counts"]
    both = materialize(_identified(docs).mapInArrow(run, "doc_id long, mark long, line int, set long, stripe int, counts binary"), "lines")
    whole = both.where("stripe is null and set is null").select("doc_id", "mark", F.col("line").alias("n_lines"))
    lines = both.where("stripe is null and set is not null").select("doc_id", "mark", "line", "set")
    return whole, lines, _rarity(both.where("stripe is not null").select("stripe", "counts"))


def _rarity(stripes: DataFrame) -> np.ndarray:
    """Sums the tasks' stripes and gives a quarter of a power of two of each count, at most 63.

    What reaches the driver is the table itself, of fixed width.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(zlib.decompress(packed), np.uint32).astype(np.int64)
                sums[k] = sums[k] + own if k in sums else own
        for k, total in sums.items():
            level = np.minimum(63, 2.5 * np.log2(np.maximum(total, 1))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["stripe", "levels"])

    table = np.zeros(1 << TABLE_BITS, np.uint8)
    dealt = stripes.repartition(1 << (TABLE_BITS - STRIPE_BITS), "stripe").mapInArrow(add, "stripe int, levels binary")
    for row in dealt.toLocalIterator():
        table[row["stripe"] << STRIPE_BITS : (row["stripe"] + 1) << STRIPE_BITS] = np.frombuffer(row["levels"], np.uint8)
    return table


def _reach(size: np.ndarray) -> np.ndarray:
    """Words of the prefix: a line of n words shares at least four fifths of them with any match."""
    return np.where(size >= SMALLEST, size - (4 * size + 4) // 5 + 1, 0)


_RECORD = np.dtype([("word", "<u8"), ("set", "<i8"), ("size", "<i4"), ("at", "<i4"), ("narrow", "<u8", 2)])


def _packed(histogram: np.ndarray) -> np.ndarray:
    """Four bits a class, sixteen classes a number."""
    wide = histogram.astype(np.uint64).reshape(len(histogram), histogram.shape[1] // 16, 16)
    return np.bitwise_or.reduce(wide << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=2)


def _unpacked(numbers: np.ndarray) -> np.ndarray:
    low = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), 8 * numbers.shape[1])
    return np.stack([low & 15, low >> 4], 2).reshape(len(numbers), low.shape[1] * 2)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The most words that two histograms can share; a class that is full in both tells nothing."""
    low = np.minimum(a, b)
    return np.where((low == 15).any(1), np.iinfo(np.int64).max, low.sum(1, dtype=np.int64))


def _enough(nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Common words that two sizes need for a similarity of 0.8."""
    return (4 * (nx + ny) + 8) // 9


class _Group:
    """Records of some prefix words, sorted by word and size."""

    def __init__(self, records: np.ndarray, wide: np.ndarray):
        # a word that one line has cannot lead to a partner
        order = np.lexsort((records["size"], records["word"]))
        word = records["word"][order]
        same = word[1:] == word[:-1]
        shared = order[np.r_[False, same] | np.r_[same, False]]
        self.word, self.set = records["word"][shared], records["set"][shared]
        self.size, self.at = records["size"][shared].astype(np.int64), records["at"][shared].astype(np.int64)
        self.narrow = _unpacked(records["narrow"][shared])
        large = records["size"] > NARROW
        place = np.where(large, np.cumsum(large) - 1, -1)
        self.place, self.wide = place[shared], wide

    def similar(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which pairs the length, positional and histogram filters leave."""
        nx, ny = self.size[x], self.size[y]
        need = _enough(nx, ny)
        ok = np.flatnonzero((5 * np.minimum(nx, ny) >= 4 * np.maximum(nx, ny)) & (self.set[x] != self.set[y]) & (
            np.minimum(self.at[x], self.at[y]) + np.minimum(nx - self.at[x], ny - self.at[y]) >= need))
        ok = ok[_common(self.narrow[x[ok]], self.narrow[y[ok]]) >= need[ok]]
        both = (self.place[x[ok]] >= 0) & (self.place[y[ok]] >= 0)
        check = ok[both]
        if len(check):
            left = _common(_unpacked(self.wide[self.place[x[check]]]), _unpacked(self.wide[self.place[y[check]]])) >= need[check]
            ok = np.r_[ok[~both], check[left]]
        return ok

    def partnered(self) -> np.ndarray:
        """The sets that have a possible partner. A set is done with the first it finds."""
        n = len(self.word)
        found = np.zeros(n, bool)
        x, k = np.arange(n - 1), 1
        while len(x):
            # sizes rise inside a word: once too large, all further ones are
            x = x[(x + k < n)]
            x = x[(self.word[x + k] == self.word[x]) & (4 * self.size[x + k] <= 5 * self.size[x])]
            open_ = x[~(found[x] & found[x + k])]
            for lo in range(0, len(open_), 1 << 16):
                part = open_[lo : lo + (1 << 16)]
                hit = part[self.similar(part, part + k)]
                found[hit] = True
                found[hit + k] = True
            k += 1
        return np.unique(self.set[found])


def _partnered(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """The sets of lines that may have a match.

    A task packs the records of its lines by groups of prefix words, so a row of
    the shuffle holds many records.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(classes)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = SPREAD * parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        known: set[int] = set()
        rows = 0

        def flush() -> pa.RecordBatch:
            records, wide = np.concatenate([r for r, _ in held]), np.concatenate([w for _, w in held])
            group = (mix(records["word"]) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            large = records["size"] > NARROW
            wide = wide[np.argsort(group[large], kind="stable")]
            records, group, large = records[order], group[order], large[order]
            names, begin = np.unique(group, return_index=True)
            ends, seen = np.r_[begin[1:], len(group)], np.r_[0, np.cumsum(large)]
            return pa.RecordBatch.from_arrays([
                pa.array(names, pa.int32()), pa.array([records[a:b].tobytes() for a, b in zip(begin, ends)], pa.binary()),
                pa.array([wide[seen[a] : seen[b]].tobytes() for a, b in zip(begin, ends)], pa.binary())], ["group", "records", "wide"])

        for batch in batches:
            for lo, hi in slices(batch.column(0), SLICE):
                lines = _Lines(batch.column(0).slice(lo, hi - lo), shared.value)
                sets, n = lines.sets(), lines.size
                fresh = np.zeros(len(n), bool)
                fresh[np.unique(sets, return_index=True)[1]] = True
                fresh &= np.array([x not in known for x in sets.tolist()], bool)
                known.update(sets[fresh].tolist())
                own = np.flatnonzero(fresh & (n >= SMALLEST))
                if not len(own):
                    continue
                narrow = np.zeros((len(n), 2), np.uint64)
                narrow[own] = _packed(lines.histogram(own, 32))
                large = own[n[own] > NARROW]
                wide = np.zeros((len(n), WIDE // 16), np.uint64)
                wide[large] = _packed(lines.histogram(large, WIDE))
                reach = np.zeros(len(n), np.int64)
                reach[own] = _reach(n[own])
                line = np.repeat(np.arange(len(n)), reach)
                at = np.arange(len(line)) - np.repeat(np.cumsum(reach) - reach, reach)
                records = np.empty(len(line), _RECORD)
                records["word"], records["set"], records["size"] = lines.words[lines.first[line] + at], sets[line], n[line]
                records["at"], records["narrow"] = at, narrow[line]
                held.append((records, wide[line[n[line] > NARROW]]))
                rows += len(records)
                if rows > POSTINGS:
                    yield flush()
                    held, rows = [], 0
                if len(known) > 2 * POSTINGS:
                    known = set()
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> pa.RecordBatch:
            records, wide = np.frombuffer(b"".join(held), _RECORD), np.frombuffer(b"".join(held_wide), np.uint64).reshape(-1, WIDE // 16)
            return pa.RecordBatch.from_arrays([pa.array(_Group(records, wide).partnered())], ["set"])

        current, held, held_wide = None, [], []
        for batch in batches:
            for group, records, wide in zip(*(c.to_pylist() for c in batch.columns)):
                if group != current and held:
                    yield found()
                    held, held_wide = [], []
                current = group
                held.append(records)
                held_wide.append(wide)
        if held:
            yield found()

    records = docs.select(F.col("text").cast("string")).mapInArrow(run, "group int, records binary, wide binary")
    return records.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(meet, "set long").distinct()


def _bit_table(keys: DataFrame, width: int) -> np.ndarray:
    """A bit for each key modulo ``width``, joined in the tasks; the table that reaches the driver has a fixed width."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(width, bool)
        for batch in batches:
            bits[(batch.column(0).to_numpy().view(np.uint64) % np.uint64(width)).astype(np.int64)] = True
        for k, part in enumerate(np.packbits(bits).reshape(16, -1)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["stripe", "bits"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(zlib.decompress(packed), np.uint8)
                sums[k] = sums[k] | own if k in sums else own
        for k, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["stripe", "bits"])

    table = np.zeros((16, width // 128), np.uint8)
    for row in keys.mapInArrow(mark, "stripe int, bits binary").repartition(16, "stripe").mapInArrow(join, "stripe int, bits binary").toLocalIterator():
        table[row["stripe"]] = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return table.ravel()


def _has(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys.view(np.uint64) % np.uint64(8 * len(table))).astype(np.int64)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _word_sets(docs: DataFrame, wanted: DataFrame, classes: np.ndarray) -> DataFrame:
    """(set, words in order of rarity) of lines in ``wanted`` (set, doc_id), and of few others.

    Bit tables of fixed width tell the tasks which texts to read and which lines to send.
    """
    sc = docs.sparkSession.sparkContext
    sets, texts, shared = (sc.broadcast(x) for x in (_bit_table(wanted.select("set"), 1 << 24), _bit_table(wanted.select(F.xxhash64("doc_id")), 1 << 24), classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked = batch.filter(pa.array(_has(texts.value, batch.column(0).to_numpy())))
            for lo, hi in slices(picked.column(1), SLICE):
                lines = _Lines(picked.column(1).slice(lo, hi - lo), shared.value)
                own = lines.sets()
                keep = np.unique(own, return_index=True)[1]
                keep = keep[_has(sets.value, own[keep])]
                words = pa.array([lines.words[lines.first[i] : lines.first[i + 1]].view(np.int64) for i in keep], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(own[keep]), words], ["set", "words"])

    named = docs.select(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))).alias("key"), F.col("text").cast("string").alias("text"))
    return named.mapInArrow(run, "set long, words array<long>")


def _matches(words: np.ndarray, first: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs of word sets have a Jaccard similarity of 0.8 or more; set ``i`` is ``words[first[i] : first[i + 1]]``."""
    size, out = np.diff(first), np.zeros(len(x), bool)
    both = size[x] + size[y]
    lo = 0
    while lo < len(x):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(both[lo : lo + (1 << 16)]), 1 << 20)))
        each = np.r_[x[lo:hi], y[lo:hi]]
        n = size[each]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[each], n)
        pair = np.repeat(np.tile(np.arange(hi - lo, dtype=np.uint64), 2)[: len(each)], n)
        keys = np.sort((pair << np.uint64(HASH_BITS)) | words[at])
        twice = (keys[1:][keys[1:] == keys[:-1]] >> np.uint64(HASH_BITS)).astype(np.int64)
        out[lo:hi] = np.bincount(twice, minlength=hi - lo) >= _enough(size[x[lo:hi]], size[y[lo:hi]])
        lo = hi
    return out


def _later(table: pa.Table) -> np.ndarray:
    """Sets that match an earlier one, of records (word, doc_id, line, set, words) sorted by word and place."""
    word, own = table["word"].to_numpy(), table["set"].to_numpy()
    lists = table["words"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    first = lists.offsets.to_numpy().astype(np.int64)
    words, first = lists.values.to_numpy().view(np.uint64)[first[0] : first[-1]], first - first[0]
    size = np.diff(first)
    bucket = (words >> np.uint64(HASH_BITS - 6)).astype(np.int64) + 64 * np.repeat(np.arange(len(size)), size)
    histogram = np.minimum(np.bincount(bucket, minlength=64 * len(size)), 15).astype(np.uint8).reshape(-1, 64)
    done = np.zeros(len(word), bool)
    x, k = np.arange(1, len(word)), 1
    while len(x):
        x = x[~done[x] & (x >= k)]
        x = x[word[x] == word[x - k]]
        for lo in range(0, len(x), 1 << 16):
            part = x[lo : lo + (1 << 16)]
            nx, ny = size[part], size[part - k]
            part = part[5 * np.minimum(nx, ny) >= 4 * np.maximum(nx, ny)]
            part = part[_common(histogram[part], histogram[part - k]) >= _enough(size[part], size[part - k])]
            done[part[_matches(words, first, part, part - k)]] = True
        k += 1
    return np.unique(own[done])


def _near(docs: DataFrame, classes: np.ndarray, firsts: DataFrame) -> DataFrame:
    """The sets (set) that match one whose first place is earlier."""
    some = materialize(_partnered(docs, classes), "partnered")
    wanted = materialize(firsts.select("set", "doc_id", "line").join(some, "set"), "wanted")
    sets = _word_sets(docs, wanted, classes).join(wanted, "set").dropDuplicates(["set"])
    size = F.size("words")
    reach = size - F.floor((4 * size + 4) / 5).cast("int") + 1
    posted = sets.select("doc_id", "line", "set", "words", F.explode(F.slice("words", 1, reach)).alias("word"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def found(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(_later(pa.Table.from_batches(parts)))], ["set"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # the last word may go on in the next batch
            words = batch.column(0).to_numpy()
            cut = int(np.searchsorted(words, words[-1]))
            if cut or (waiting and waiting[0].column(0)[0].as_py() != words[-1]):
                done = [*waiting, *([batch.slice(0, cut)] if cut else [])]
                if done:
                    yield found(done)
                waiting = []
            waiting.append(batch.slice(cut))
        if waiting:
            yield found(waiting)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = posted.select("word", "doc_id", "line", "set", "words").repartition(parts, "word").sortWithinPartitions("word", "doc_id", "line", "set")
    return materialize(dealt.mapInArrow(run, "set long").distinct(), "removed")


def removed_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents (doc_id, mark, n_lines with words), and (doc_id, mark, removed: sorted numbers of the lines that go, from 0) of those that lose any.

    ``mark`` is a hash of the text; doc_id is the largest long for null.
    """
    whole, lines, classes = _scan(docs)
    firsts = materialize(lines.groupBy("set").agg(F.min(F.struct("doc_id", "line")).alias("p"), F.count(F.lit(1)).alias("n")).select("set", "p.doc_id", "p.line", "n"), "sets")
    near = _near(docs, classes, firsts).withColumn("near", F.lit(True))
    # sets of which any line goes
    fate = firsts.join(near, "set", "left").where("n > 1 or near").select(
        "set", F.col("doc_id").alias("first_doc"), F.col("line").alias("first_line"), F.coalesce("near", F.lit(False)).alias("near"))
    goes = F.col("near") | (F.col("doc_id") != F.col("first_doc")) | (F.col("line") != F.col("first_line"))
    gone = lines.join(materialize(fate, "fate"), "set").where(goes)
    return whole, gone.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def dedupe_lines(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines (with words), n_removed, and removed_lines (numbers from 0, comma-joined).

    A line goes if an earlier one, by doc_id and line number, has the same words
    or a Jaccard similarity of 0.8 or more with it; the number of removed lines
    is the document's number of links to earlier lines. Lines without words never
    go. Null and empty texts have no lines; null ids come last; of lines at the
    same place of rows that share an id with different texts one counts as
    earlier; rows with the same id and text are treated alike. An empty table
    gives no rows; extra columns are ignored.
    """
    whole, gone = removed_lines(docs)
    null = F.when(F.col("doc_id") != _LAST, F.col("doc_id"))
    return whole.join(gone, ["doc_id", "mark"], "left").select(
        null.alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed_lines"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without the removed lines, all columns kept; a document that had words and lost all of its lines goes."""
    whole, gone = removed_lines(docs)
    counts = whole.dropDuplicates(["doc_id", "mark"])
    found = gone.join(counts, ["doc_id", "mark"]).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_text"), F.col("removed").alias("_gone"), (F.size("removed") == F.col("n_lines")).alias("_all"))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names of the caller's columns may clash
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    joined = plain.withColumn("_key", F.coalesce(doc_id.cast("long"), F.lit(_LAST))).withColumn("_mark", F.xxhash64(text))
    joined = joined.join(materialize(found, "gone"), (F.col("_key") == F.col("_id")) & (F.col("_mark") == F.col("_text")), "left").where(~F.coalesce("_all", F.lit(False)))
    left = F.array_join(F.filter(F.split(text.cast("string"), "\n"), lambda _, i: ~F.array_contains("_gone", i)), "\n")
    return joined.select(*[F.when(F.col("_gone").isNull(), F.col(f"c{i}")).otherwise(left).alias(c) if c == "text" else F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
