"""Exact dedup by Patricia-trie owners.

A text's key is its length in bytes, its SHA-256 and then its full bytes, all
after deleting white space (``[\\x20\\x09-\\x0D]``). Keys go into compressed
radix tries whose terminal nodes store the owner of the text: the row with the
most code points in the original text, then the smallest doc_id (null last),
then the first row.

Two steps, both streamed over Arrow batches:

* Each input task inserts its rows into a trie of its own and sends one partial
  owner per distinct text, so a text copied a million times leaves a task once.
  The trie is emptied into partials whenever it holds ``TASK_BYTES`` of keys.
* Partials are partitioned by (length, hash) and sorted by it. A partition's
  trie only holds the subtree of the current (length, hash) prefix: when the
  prefix changes that subtree is complete, its owners are emitted and it is
  dropped. Equal texts meet in one terminal; texts that only share the hash
  stay apart, because the full bytes are compared.

Rows find their owner by a join on the partial's id, which is the row id of
its first row in the task; no text is shuffled twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelwright.sources.scratch import materialize

BLANK = r"[\x20\x09-\x0D]"  # fixed: characters that do not count in equality
TASK_BYTES = 32 << 20  # key bytes a task's trie holds before it is emptied into partials

_ROW, _PART = 0, 1
_MAPPED = "kind int, row_id long, doc_id long, string_id long, len long, sha string, norm binary, " \
          "best_chars long, best_doc long, best_row long, copies long"
_OWNERS = "string_id long, keep_id long, keep_row long, group_size long, text_sha256 string"


class _Node:
    __slots__ = ("edges", "value")

    def __init__(self):
        self.edges: dict[int, tuple[bytes, _Node]] = {}
        self.value = None


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common start of ``label`` and ``key[at:]``, by halving slices compared in C."""
    if key.startswith(label, at):
        return len(label)
    lo, hi = 0, min(len(label), len(key) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if label[:mid] == key[at:at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class PatriciaTrie:
    """A compressed radix trie of byte strings; ``terminal`` returns the node of a key, made if new."""

    def __init__(self):
        self.root = _Node()
        self.key_bytes = 0

    def terminal(self, key: bytes) -> _Node:
        node, at = self.root, 0
        while at < len(key):
            edge = node.edges.get(key[at])
            if edge is None:
                leaf = _Node()
                node.edges[key[at]] = (key[at:], leaf)
                self.key_bytes += len(key) - at
                return leaf
            label, child = edge
            common = _common(label, key, at)
            if common < len(label):
                middle = _Node()
                middle.edges[label[common]] = (label[common:], child)
                node.edges[key[at]] = (label[:common], middle)
                child = middle
            node, at = child, at + common
        return node

    def terminals(self) -> Iterator[_Node]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.value is not None:
                yield node
            stack.extend(child for _, child in node.edges.values())


def _key(length: int, sha: str, norm: bytes) -> bytes:
    return length.to_bytes(8, "big") + bytes.fromhex(sha) + norm


def _owner(chars: int, doc, row: int) -> tuple:
    """Sorts first for the row that stays: most code points, smallest doc_id (null last), first row."""
    return -chars, doc is None, doc if doc is not None else 0, row


def _map_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row records (row_id, doc_id, string_id) and one partial a distinct text of the task."""
    trie = PatriciaTrie()

    def partials() -> pa.RecordBatch:
        rows = [node.value for node in trie.terminals()]
        cols = {"kind": [_PART] * len(rows), "row_id": [None] * len(rows), "doc_id": [None] * len(rows),
                "string_id": [r[0] for r in rows], "len": [r[1] for r in rows], "sha": [r[2] for r in rows],
                "norm": [r[3] for r in rows], "best_chars": [-r[4][0] for r in rows],
                "best_doc": [None if r[4][1] else r[4][2] for r in rows], "best_row": [r[4][3] for r in rows],
                "copies": [r[5] for r in rows]}
        return pa.RecordBatch.from_pydict(cols, schema=_MAPPED_SCHEMA)

    for batch in batches:
        data = batch.to_pydict()
        string_ids = []
        for row, doc, norm, length, sha, chars in zip(data["row_id"], data["doc_id"], data["norm"], data["len"], data["sha"], data["chars"]):
            node = trie.terminal(_key(length, sha, norm))
            owner = _owner(chars, doc, row)
            if node.value is None:
                node.value = [row, length, sha, norm, owner, 1]
            else:
                node.value[5] += 1
                node.value[4] = min(node.value[4], owner)
            string_ids.append(node.value[0])
        n = len(string_ids)
        yield pa.RecordBatch.from_pydict(
            {"kind": [_ROW] * n, "row_id": data["row_id"], "doc_id": data["doc_id"], "string_id": string_ids, "len": [None] * n,
             "sha": [None] * n, "norm": [None] * n, "best_chars": [None] * n, "best_doc": [None] * n, "best_row": [None] * n,
             "copies": [None] * n}, schema=_MAPPED_SCHEMA)
        if trie.key_bytes >= TASK_BYTES:
            yield partials()
            trie = PatriciaTrie()
    yield partials()


def _reduce_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partials sorted by (len, sha): one trie a prefix, emptied into the output when the prefix changes."""
    trie, prefix = PatriciaTrie(), None
    out = {name: [] for name in _OWNERS_SCHEMA.names}

    def settle() -> None:
        for node in trie.terminals():
            best, copies, ids, sha = node.value
            out["string_id"].extend(ids)
            out["keep_id"].extend([None if best[1] else best[2]] * len(ids))
            out["keep_row"].extend([best[3]] * len(ids))
            out["group_size"].extend([copies] * len(ids))
            out["text_sha256"].extend([sha] * len(ids))

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pydict(out, schema=_OWNERS_SCHEMA)
        for values in out.values():
            values.clear()
        return batch

    for batch in batches:
        data = batch.to_pydict()
        for string_id, length, sha, norm, chars, doc, row, copies in zip(
                data["string_id"], data["len"], data["sha"], data["norm"], data["best_chars"], data["best_doc"], data["best_row"], data["copies"]):
            if (length, sha) != prefix:
                settle()
                trie, prefix = PatriciaTrie(), (length, sha)
            node = trie.terminal(_key(length, sha, norm))
            owner = _owner(chars, doc, row)
            if node.value is None:
                node.value = [owner, copies, [string_id], sha]
            else:
                node.value[0] = min(node.value[0], owner)
                node.value[1] += copies
                node.value[2].append(string_id)
        if len(out["string_id"]) >= 4096:
            yield flush()
    settle()
    yield flush()


def _schema(ddl: str) -> pa.Schema:
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([pa.field(name, types[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


_MAPPED_SCHEMA, _OWNERS_SCHEMA = _schema(_MAPPED), _schema(_OWNERS)


def normalized(text) -> "F.Column":
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row, dropped ones too.

    Texts are equal when equal after deleting every character of ``BLANK``; a null
    text counts as empty, so nulls, empty and blank texts form one group. Of a
    group, the row with the most code points in its original text stays, then
    the smallest doc_id (null doc_ids last), then the first row read: repeated
    rows keep one. ``keep_id`` is that row's doc_id (null if it has none),
    ``group_size`` counts the group's rows, ``text_sha256`` hashes the
    normalised text's UTF-8 bytes. An empty table gives no rows; other columns,
    whatever their names, are ignored.
    """
    norm = normalized(F.col("text").cast("string"))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
        F.encode(norm, "UTF-8").alias("norm"), F.octet_length(norm).cast("long").alias("len"), F.sha2(norm, 256).alias("sha"),
        F.char_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("chars"))
    mapped = materialize(rows.mapInArrow(_map_side, _MAPPED), "exact-dedup-mapped")
    parts = mapped.where(F.col("kind") == _PART).drop("kind", "row_id", "doc_id")
    owners = parts.repartition("len", "sha").sortWithinPartitions("len", "sha").mapInArrow(_reduce_side, _OWNERS)
    return (mapped.where(F.col("kind") == _ROW).select("row_id", "doc_id", "string_id").join(owners, "string_id")
            .select("doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"), "text_sha256"))


#: DuckDB form of ``exact_duplicates`` over ``documents``.
ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
r AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id ASC NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id ASC NULLS LAST) = 1 AS kept
  FROM t)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, kept, sha256(norm) AS text_sha256 FROM r
"""
