"""Token streams of documents packed in chunks, and the TF-IDF weights of their n-grams.

A chunk numbers its distinct words and holds its documents as numbers, so its
n-grams are counted on integers and their texts are made once a chunk. Only the
distinct n-grams of a chunk are shuffled, sorted and compressed, and only their
document frequencies come back.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from panelwright.sources.scratch import materialize

# Tokens of a chunk; the row that crosses this stays whole.
CHUNK = 1 << 19
# Tokens whose n-grams one task counts, about; repeats inside a chunk have been summed before.
PART = 1 << 21
OUT_ROWS = 1 << 16
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_MIX = np.uint64(0x9E3779B97F4A7C15)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs in the block sends at most so many rows to Python at once."""
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def _numbers(a: np.ndarray) -> bytes:
    """Whole numbers from 0 in the narrowest type that holds them, after one byte with its size; first all low bytes, which packs better."""
    size = np.min_scalar_type(int(a.max(initial=0))).itemsize
    return bytes([size]) + a.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes()


def _squeezed(*parts: bytes) -> bytes:
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)


class _Reader:
    """Reads the parts of ``_squeezed`` one after the other."""

    def __init__(self, blob: bytes):
        self.raw = pa.decompress(memoryview(blob)[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
        self.at = 0

    def numbers(self, n: int) -> np.ndarray:
        size = self.raw[self.at]
        out = np.frombuffer(self.raw, np.uint8, n * size, self.at + 1).reshape(size, n)
        self.at += 1 + n * size
        return np.ascontiguousarray(out.T).view(f"<u{size}").reshape(n)

    def rest(self) -> np.ndarray:
        return np.frombuffer(self.raw, np.uint8, offset=self.at)


def _layout(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array without NULLs."""
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def _texts(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _packed(ids: pa.Array, runs: np.ndarray, codes: np.ndarray, words: pa.Array, tfs: np.ndarray | None, low: int, high: int,
            schema: pa.Schema) -> pa.RecordBatch:
    offsets, data = _layout(words)
    values = {
        "_chunk": [uuid.uuid4().hex], "_whole": [tfs is None], "_low": [low], "_high": [high],
        "_ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.cast(schema.field("_ids").type.value_type)),
        "_n_codes": [len(codes)], "_n_words": [len(words)],
        "_codes": [_squeezed(_numbers(runs), _numbers(codes), _numbers(tfs) if tfs is not None else b"")],
        "_words": [_squeezed(_numbers(np.diff(offsets)), data[offsets[0]:offsets[-1]].tobytes())],
    }
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, schema.field(k).type) for k, v in values.items()], list(values))


def _numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers from 1 in text order, 0 for NULL, and the distinct texts."""
    coded = values.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order) + 1, np.int64)
    place[order], place[-1] = np.arange(1, len(order) + 1), 0
    return place[coded.indices.fill_null(len(order)).to_numpy()], coded.dictionary.take(pa.array(order))


def _streams(batches: Iterator[pa.RecordBatch], low: int, high: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Chunks of rows (id, tokens); a 0 ends each row and stands for a NULL token."""
    held: list[pa.RecordBatch] = []
    n = 0

    def flush() -> pa.RecordBatch:
        ids, lists = (pa.concat_arrays([b.column(i) for b in held]) for i in (0, 1))
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
        numbers, words = _numbered(lists.flatten())
        codes = np.zeros(len(numbers) + len(sizes), np.int64)
        codes[np.arange(len(numbers)) + np.repeat(np.arange(len(sizes)), sizes)] = numbers
        return _packed(ids, sizes + 1, codes, words, None, low, high, schema)

    for batch in batches:
        ends, at = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy()), 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            to = min(len(ends), int(np.searchsorted(ends, before + CHUNK - n)) + 1)
            held.append(batch.slice(at, to - at))
            n, at = n + int(ends[to - 1] - before), to
            if n >= CHUNK:
                yield flush()
                held, n = [], 0
    if n:
        yield flush()


def _entries(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Chunks of rows (id, term, tf): each term counts as one word with a given frequency. Rows without a term are left out."""
    held: list[pa.RecordBatch] = []
    n = 0

    def flush() -> pa.RecordBatch:
        ids, terms, tfs = (pa.concat_arrays([b.column(i) for b in held]) for i in (0, 1, 2))
        numbers, words = _numbered(terms)
        return _packed(ids, np.ones(len(ids), np.int64), numbers, words, tfs.to_numpy(), 1, 1, schema)

    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column(1)))
        for at in range(0, len(batch), CHUNK):
            held.append(batch.slice(at, CHUNK))
            n += len(held[-1])
            if n >= CHUNK:
                yield flush()
                held, n = [], 0
    if n:
        yield flush()


def _chunk_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType().add("_chunk", "string").add("_whole", "boolean").add("_low", "integer").add("_high", "integer").add(
        "_ids", T.ArrayType(id_type)).add("_n_codes", "integer").add("_n_words", "integer").add("_codes", "binary").add("_words", "binary")


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def pack_streams(rows: DataFrame, id_col: str, toks: str, low: int, high: int) -> DataFrame:
    """Chunks of token rows whose ids are each the id of one row."""
    schema = _chunk_schema(rows.schema[id_col].dataType)
    arrow = _arrow(schema)
    return rows.select(id_col, toks).mapInArrow(lambda batches: _streams(batches, low, high, arrow), schema)


def pack_counts(counts: DataFrame, id_col: str) -> DataFrame:
    """Chunks of rows (id, term, tf); an id may be in any number of them."""
    schema = _chunk_schema(counts.schema[id_col].dataType)
    arrow = _arrow(schema)
    return counts.select(id_col, "term", F.col("tf").cast("long")).mapInArrow(lambda batches: _entries(batches, arrow), schema)


def is_packed(counts: DataFrame) -> bool:
    return "_chunk" in counts.columns


def _grams(codes: np.ndarray, words: pa.Array, low: int, high: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where n-grams begin, which text each has, and the texts, all of them different."""
    base, at = len(words) + 1, np.flatnonzero(codes)
    which, texts, first, found = codes[at].astype(np.int32) - 1, words, 0, []
    for n in range(1, high + 1):
        if n > 1:
            inside = at + (n - 1) < len(codes)
            at, which = at[inside], which[inside]
            last = codes[at + (n - 1)].astype(np.int64)
            at, keys = at[last > 0], (which.astype(np.int64) * base + last)[last > 0]
            pairs, which = np.unique(keys, return_inverse=True)
            which = which.astype(np.int32)
            texts = pc.binary_join_element_wise(texts.take(pa.array(pairs // base)), words.take(pa.array(pairs % base - 1)), pa.scalar(" ", words.type))
        if n >= low:
            found.append((at, which + np.int32(first), texts))
            first += len(texts)
    where, which, texts = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), pa.concat_arrays([f[2] for f in found])
    if high > 1 and pc.any(pc.match_substring(words, " ")).as_py():  # then words of different cuts may make the same text
        coded = texts.dictionary_encode()
        which, texts = coded.indices.to_numpy()[which], coded.dictionary
    return where, which, texts


def _postings(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Document, term and frequency of each pair in a chunk, and the texts of the terms."""
    n, reader, words = row["_n_codes"], _Reader(row["_codes"]), _Reader(row["_words"])
    runs, codes = reader.numbers(len(row["_ids"])), reader.numbers(n)
    where, which, texts = _grams(codes, _texts(words.numbers(row["_n_words"]), words.rest()), row["_low"], row["_high"])
    document = np.repeat(np.arange(len(runs), dtype=np.int32), runs)[where]
    if not row["_whole"]:
        return document, which, reader.numbers(n)[where].astype(np.int64), texts
    terms = max(1, len(texts))
    pairs, tf = np.unique(document.astype(np.int64) * terms + which, return_counts=True)
    return (pairs // terms).astype(np.int32), (pairs % terms).astype(np.int32), tf, texts


def _rows(table: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    """The chunks of a table; the ids stay an array."""
    for i in range(table.num_rows):
        yield {k: table.column(k)[i].values if k == "_ids" else table.column(k)[i].as_py() for k in table.schema.names}


def _parts(texts: pa.Array, parts: int) -> np.ndarray:
    """The part that counts each text: a hash of its length and up to 4,096 of its bytes, the same in every chunk."""
    offsets, data = _layout(texts)
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    start, size = offsets[:-1], np.diff(offsets)
    out, live = size.astype(np.uint64) * _MIX, np.arange(len(size))
    for k in range(0, min(4096, int(size.max(initial=0))), 8):
        live = live[size[live] > k]
        word, left = eights[start[live] + k], np.minimum(size[live] - k, 8)
        word = word & (np.uint64(2**64 - 1) >> (np.uint64(64) - left.astype(np.uint64) * np.uint64(8)))
        mixed = (out[live] ^ word) * _MIX
        out[live] = mixed ^ (mixed >> np.uint64(29))
    return ((out >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


def _order(texts: pa.Array, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the texts by part, and the border of each part in it."""
    part = _parts(texts, parts)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _send(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """The distinct terms of a chunk with their documents in it, by part."""
    for batch in batches:
        for row in _rows(batch):
            _, term, _, texts = _postings(row)
            order, borders = _order(texts, parts)
            df = np.bincount(term, minlength=len(texts))[order]
            offsets, data = _layout(texts.take(pa.array(order)))
            sizes, some = np.diff(offsets), [p for p in range(parts) if borders[p] < borders[p + 1]]
            blobs = [_squeezed(_numbers(sizes[a:b]), _numbers(df[a:b]), data[offsets[a]:offsets[b]].tobytes()) for a, b in ((borders[p], borders[p + 1]) for p in some)]
            yield pa.RecordBatch.from_pydict({
                "_part": pa.array(some, pa.int32()), "_chunk": pa.array([row["_chunk"]] * len(some), pa.string()),
                "_whole": pa.array([row["_whole"]] * len(some), pa.bool_()),
                "_n": pa.array(np.diff(borders)[some], pa.int32()), "_terms": pa.array(blobs, pa.binary())})


def _count(sent: pa.Table) -> pa.Table:
    """The document frequencies of the terms of one part, in the order of each chunk."""
    n = sent.column("_n").to_numpy()
    borders, sizes, counts, data = np.concatenate([[0], np.cumsum(n)]), [], [], []
    for size, blob in zip(n, sent.column("_terms")):
        reader = _Reader(blob.as_py())
        sizes.append(reader.numbers(size))
        counts.append(reader.numbers(size))
        data.append(reader.rest())
    texts = _texts(np.concatenate(sizes), np.concatenate(data))
    del sizes, data
    which = texts.dictionary_encode().indices.to_numpy()
    del texts
    df = np.bincount(which, weights=np.concatenate(counts)).astype(np.int64)[which]
    blobs = [_squeezed(_numbers(df[a:b])) for a, b in zip(borders, borders[1:])]
    return sent.select(["_part", "_chunk", "_whole", "_n"]).append_column("_dfs", pa.array(blobs, pa.binary()))


def _frequencies(chunks: DataFrame, parts: int) -> DataFrame:
    sent = chunks.mapInArrow(lambda batches: _send(batches, parts), "_part int, _chunk string, _whole boolean, _n int, _terms binary")
    return sent.groupBy("_part").applyInArrow(_count, "_part int, _chunk string, _whole boolean, _n int, _dfs binary")


def _weighted(row: dict, found: pa.Table, parts: int, n_docs: int) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Document, term, texts, and TF-IDF weight before and after the division by the norm of the document in the chunk."""
    document, term, tf, texts = _postings(row)
    order, _ = _order(texts, parts)
    found = found.sort_by("_part")
    df = np.empty(len(texts), np.int64)
    df[order] = np.concatenate([_Reader(b.as_py()).numbers(n.as_py()) for n, b in zip(found.column("_n"), found.column("_dfs"))])
    raw = tf * (np.log((n_docs + 1) / (df + 1)) + 1)[term]
    norm = np.sqrt(np.bincount(document, raw * raw, minlength=len(row["_ids"])))[document]
    return document, term, texts, raw, norm


def weights(chunks: DataFrame, id_col: str, n_docs: int, whole: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, term, ``whole``) of the chunks of whole documents, and rows (id, term, raw) of the others.

    Chunks are written once, and so are the document frequencies of their terms;
    a chunk then meets its own frequencies.
    """
    spark = chunks.sparkSession
    tokens = chunks.agg(F.sum(F.col("_n_codes").cast("long") * (F.col("_high") - F.col("_low") + 1))).first()[0] or 0
    parts = int(max(1, -(-tokens // PART)))
    with small_batches(spark, 4):
        dfs = materialize(_frequencies(chunks, parts), "document-frequencies")
    id_type = chunks.schema["_ids"].dataType.elementType

    def run(all_of_it: bool, name: str) -> DataFrame:
        schema = T.StructType().add(id_col, id_type).add("term", "string").add(name, "double")
        arrow = _arrow(schema)

        def meet(chunk: pa.Table, found: pa.Table) -> pa.Table:
            out = []
            for row in _rows(chunk) if found.num_rows else ():  # a chunk of NULL tokens has no terms
                document, term, texts, value, norm = _weighted(row, found, parts, n_docs)
                for a in range(0, len(document), OUT_ROWS):
                    some, v = slice(a, a + OUT_ROWS), value[a:a + OUT_ROWS]
                    if all_of_it:
                        v = pa.array(np.divide(v, norm[some], out=np.zeros_like(v), where=norm[some] != 0), mask=norm[some] == 0)
                    out.append(pa.RecordBatch.from_arrays([
                        row["_ids"].take(pa.array(document[some])).cast(arrow.field(0).type), texts.take(pa.array(term[some])).cast(pa.string()), pa.array(v)], schema=arrow))
            return pa.Table.from_batches(out, arrow)

        kind = F.col("_whole") == all_of_it
        return chunks.where(kind).groupBy("_chunk").cogroup(dfs.where(kind).groupBy("_chunk")).applyInArrow(meet, schema)

    return run(True, whole), run(False, "raw")


def unpacked(chunks: DataFrame, id_col: str) -> DataFrame:
    """Rows (id, term, tf) of the chunks."""
    schema = T.StructType().add(id_col, chunks.schema["_ids"].dataType.elementType).add("term", "string").add("tf", "long")
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                document, term, tf, texts = _postings(row)
                for a in range(0, len(document), OUT_ROWS):
                    some = slice(a, a + OUT_ROWS)
                    yield pa.RecordBatch.from_arrays([row["_ids"].take(pa.array(document[some])).cast(arrow.field(0).type),
                                                      texts.take(pa.array(term[some])).cast(pa.string()), pa.array(tf[some], pa.int64())], schema=arrow)

    return chunks.mapInArrow(run, schema)
