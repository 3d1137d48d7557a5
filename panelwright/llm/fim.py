"""Fill-in-middle transformation by secondary-sort assembly.

A document is cut into units (lines, ``[^\\n]*\\n|[^\\n]+``). Its prefix, middle
and suffix are runs of whole units, chosen by a hash of the doc_id. Each unit
becomes a piece keyed by (document, output position); sentinels are pieces of
their own. Pieces are partitioned by document and sorted inside their
partition, so one task streams a document's output in order into an
incremental SHA-256, never holding the whole text.

Restoration reads only the output: while streaming, each piece learns its
segment from the last sentinel before it and its place inside that segment.
The same partition is then sorted again by (document, restored position) and
streamed into a second digest. No second shuffle is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

UNIT = r"[^\n]*\n|[^\n]+"
# fixed values: sentinels of prefix, suffix and middle, the hash's prefix
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SALT = "7:"
FIM_RATE = 100  # percent of documents that are transformed
SPM_RATE = 50  # percent of transformed documents in suffix-prefix-middle order

_HEAD = -1
_RESTORED_ORDER = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_PIECES = "key long, slot int, idx long, text string, doc_id long, n long, form string, prefix_chars long, middle_chars long"
_TAGGED = "key long, rseg int, ridx long, text string, doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string"
_DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def _hash_part(hexdigest: Column, k: int) -> Column:
    return F.conv(F.substring(hexdigest, 8 * k + 1, 8), 16, 10).cast("long")


def plan(docs: DataFrame, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """One row per input row: key, doc_id, units, n, lo, hi, form, prefix_chars, middle_chars.

    h1 to h4 are the first four 8-digit groups of the SHA-256 of ``SALT`` and the
    decimal doc_id (a null doc_id counts as empty). The prefix ends after
    min(h1, h2) mod (n+1) units, the middle after the max.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(SALT), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))), 256)
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.regexp_extract_all(text, F.lit(UNIT), 0).alias("units"), text.alias("text"), digest.alias("digest"))
    n = F.size("units").cast("long")
    a, b = _hash_part(F.col("digest"), 0) % (n + 1), _hash_part(F.col("digest"), 1) % (n + 1)
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    form = (F.when((n == 0) | marked | (_hash_part(F.col("digest"), 2) % 100 >= fim_rate), "plain")
            .when(_hash_part(F.col("digest"), 3) % 100 < spm_rate, "spm").otherwise("psm"))
    staged = rows.select("key", "doc_id", "units", n.alias("n"), F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"), form.alias("form"))

    def chars(start: Column, length: Column) -> Column:
        return F.aggregate(F.slice("units", start.cast("int"), length.cast("int")), F.lit(0).cast("long"), lambda acc, u: acc + F.char_length(u))

    plain = F.col("form") == "plain"
    return staged.select(
        "*", F.when(~plain, chars(F.lit(1), F.col("lo"))).alias("prefix_chars"),
        F.when(~plain, chars(F.col("lo") + 1, F.col("hi") - F.col("lo"))).alias("middle_chars"))


def fim_pieces(docs: DataFrame, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """The output as pieces: key, slot, idx, text; one header piece (slot -1) a document carries its facts.

    Sorted by (key, slot, idx), the texts of a key's pieces are its output:
    ``PREFIX`` prefix ``SUFFIX`` suffix ``MIDDLE`` middle (psm), ``SUFFIX``
    suffix ``PREFIX`` prefix ``MIDDLE`` middle (spm), or the text (plain).
    """
    staged = plan(docs, fim_rate, spm_rate)
    form, lo, hi = F.col("form"), F.col("lo"), F.col("hi")

    def slot(i: Column) -> Column:
        before, after = i < lo, i >= hi
        return (F.when(form == "plain", 1).when(form == "psm", F.when(before, 1).when(after, 3).otherwise(5))
                .otherwise(F.when(before, 3).when(after, 1).otherwise(5)))

    piece = lambda s, i, t: F.struct(F.lit(s).cast("int").alias("slot") if isinstance(s, int) else s.cast("int").alias("slot"),
                                     i.cast("long").alias("idx"), t.cast("string").alias("text"))
    head = F.array(piece(_HEAD, F.lit(0), F.lit(None)))
    first, second = F.when(form == "psm", PREFIX).otherwise(SUFFIX), F.when(form == "psm", SUFFIX).otherwise(PREFIX)
    sentinels = F.when(form == "plain", F.array().cast("array<struct<slot:int,idx:long,text:string>>")).otherwise(
        F.array(piece(0, F.lit(0), first), piece(2, F.lit(0), second), piece(4, F.lit(0), F.lit(MIDDLE))))
    units = F.transform("units", lambda u, i: piece(slot(i), i, u))
    exploded = staged.select("*", F.explode(F.concat(head, sentinels, units)).alias("p"))
    is_head = F.col("p.slot") == _HEAD
    facts = [F.when(is_head, F.col(c)).alias(c) for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars")]
    return exploded.select("key", F.col("p.slot").alias("slot"), F.col("p.idx").alias("idx"), F.col("p.text").alias("text"), *facts)


def _schema(ddl: str) -> pa.Schema:
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.schema([pa.field(name, types[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


_TAGGED_SCHEMA, _DIGESTS_SCHEMA = _schema(_TAGGED), _schema(_DIGESTS)


def _stream_output(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in output order: digest of the output, and each piece tagged with its restored place."""
    key, head, digest, segment, counts = None, None, None, None, {}
    out = {name: [] for name in _TAGGED_SCHEMA.names}

    def emit(k, rseg, ridx, text, facts=(None,) * 6):
        for name, value in zip(_TAGGED_SCHEMA.names, (k, rseg, ridx, text, *facts)):
            out[name].append(value)

    def close():
        if key is not None:
            emit(key, _HEAD, 0, None, (*head, digest.hexdigest()))

    for batch in batches:
        data = batch.to_pydict()
        for k, slot, text, *facts in zip(data["key"], data["slot"], data["text"], data["doc_id"], data["n"], data["form"],
                                          data["prefix_chars"], data["middle_chars"]):
            if slot == _HEAD:
                close()
                key, head, digest, segment, counts = k, facts, hashlib.sha256(), None, {}
                continue
            digest.update(text.encode("utf-8"))
            if head[2] == "plain":
                segment = PREFIX
            elif text in _RESTORED_ORDER:
                segment = text
                continue
            ridx = counts.get(segment, 0)
            counts[segment] = ridx + 1
            emit(k, _RESTORED_ORDER[segment], ridx, text)
        if len(out["key"]) >= 4096:
            yield pa.RecordBatch.from_pydict(out, schema=_TAGGED_SCHEMA)
            out = {name: [] for name in _TAGGED_SCHEMA.names}
    close()
    yield pa.RecordBatch.from_pydict(out, schema=_TAGGED_SCHEMA)


def _stream_restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in restored order, the header first: one digest row a document."""
    head, digest = None, None
    out = {name: [] for name in _DIGESTS_SCHEMA.names}

    def close():
        if head is not None:
            for name, value in zip(_DIGESTS_SCHEMA.names, (*head, digest.hexdigest())):
                out[name].append(value)

    for batch in batches:
        data = batch.to_pydict()
        for rseg, text, *facts in zip(data["rseg"], data["text"], data["doc_id"], data["n"], data["form"],
                                      data["prefix_chars"], data["middle_chars"], data["output_sha256"]):
            if rseg == _HEAD:
                close()
                head, digest = facts, hashlib.sha256()
            else:
                digest.update(text.encode("utf-8"))
        if len(out["doc_id"]) >= 4096:
            yield pa.RecordBatch.from_pydict(out, schema=_DIGESTS_SCHEMA)
            out = {name: [] for name in _DIGESTS_SCHEMA.names}
    close()
    yield pa.RecordBatch.from_pydict(out, schema=_DIGESTS_SCHEMA)


def fim_digests(docs: DataFrame, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256: one row per input row.

    Null texts count as empty; empty texts and texts holding a sentinel stay
    plain (prefix_chars and middle_chars null). Repeated rows and repeated
    doc_ids are transformed alike and each gives a row. A text without a line
    break is one unit; a very long text streams through one task in pieces. An
    empty table gives no rows; other columns are ignored.
    """
    pieces = fim_pieces(docs, fim_rate, spm_rate)
    ordered = pieces.repartition("key").sortWithinPartitions("key", "slot", "idx")
    tagged = ordered.mapInArrow(_stream_output, _TAGGED)
    return tagged.sortWithinPartitions("key", "rseg", "ridx").mapInArrow(_stream_restored, _DIGESTS)
