"""Mixing sources to target weights by hash-random order and exact budgets.

Rows of a source are ordered by a hash of their id. The hash is uniform, so its
leading bits cut every source into even ranges; sums of these ranges, added up
per source, give each range its offset, and a running sum inside the range the
rest. A source's budget cuts this order at an exact word: whole epochs first,
then the leading documents once more, of which the last may be taken in part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwright.llm.ranges import range_of
from panelwright.sources.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)  # of sources in code point order, repeating, null last
SHARE = (3, 2)  # the mix holds this fraction of all words
EPOCHS = 2  # a source gives at most this many times its words
ROWS_A_RANGE = 4096


def word_count(text: Column) -> Column:
    """Words between white space; zero for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash_key(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id's text, so that any engine gives the same order."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def source_rank(sizes: DataFrame) -> DataFrame:
    """Adds ``rank`` (from 0) in code point order of ``source``, null last.

    Sources are cut into ranges by a mergeable sketch of a text prefix's order; no task gets all of them.
    """
    lead = F.conv(F.rpad(F.substring(F.hex(F.encode(F.coalesce(F.col("source"), F.lit("")), "UTF-8")), 1, 14), 14, "0"), 16, 10).cast("long")
    ranges = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = sizes.withColumn("_null", F.col("source").isNull()).withColumn("_lead", lead)
    edges = keyed.agg(F.percentile_approx("_lead", [i / ranges for i in range(1, ranges)] or [0.5], 10_000)).first()[0] or []
    cut = keyed.withColumn("_range", F.when(F.col("_null"), len(edges)).otherwise(range_of(F.col("_lead"), sorted(set(edges)))))
    counts = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_below", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("_null", "source"))
    return cut.withColumn("_inside", inside).join(F.broadcast(counts.select("_range", "_below")), "_range").select(
        *sizes.columns, (F.col("_below") + F.col("_inside") - 1).cast("long").alias("rank"))


def with_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Adds ``target`` to (source, source_size).

    Weights share out the whole; what exceeds ``epochs`` times a source's size
    goes to the others by weight, until none exceeds it. Each round of that is
    one aggregate over the sources.
    """
    weight = F.element_at(F.lit(list(weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialize(source_rank(sizes).withColumn("weight", weight.cast("long")), "sources")
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share[0] / share[1]
    most, level = F.col("source_size") * epochs, None
    closed = (0, 0)
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level[0]) / F.lit(level[1]) >= most
        words, left, n = ranked.agg(
            F.coalesce(F.sum(F.when(full, most)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.count(F.when(full, 1))).first()
        if not left or (level is not None and (words, n) == closed):
            break
        closed, level = (words, n), (float(total - words), float(left))
    target = most.cast("double") if level is None else F.least(most.cast("double"), F.col("weight") * F.lit(level[0]) / F.lit(level[1]))
    return ranked.select(*sizes.columns, target.alias("target"))


def _derived(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The carried columns as one struct, out of reach of clashing names, next to what decides."""
    source = F.col("source").cast("string")
    return docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"), source.alias("source"),
        F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)).alias("source_key"),
        _hash_key(F.coalesce(F.col("doc_id").cast("string"), F.col("text").cast("string"))).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text").cast("string")).alias("size"), F.xxhash64("text").alias("mark"))


def plan_mix(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Every row as ``row`` (a struct of the carried columns) with size, source_size, target, epochs, again and taken.

    A row is taken ``epochs`` times whole, and its first ``again`` words once more.
    """
    rows = docs.select(F.count(F.lit(1))).first()[0]
    bits = min(40, (rows // ROWS_A_RANGE).bit_length())  # leading bits of the hash: ranges of about ROWS_A_RANGE rows
    part = F.shiftright("key", 60 - bits)
    cut = ["source_key", "part"]
    sums = materialize(_derived(docs, ["doc_id"]).withColumn("part", part).groupBy("source", *cut).agg(F.sum("size").alias("words")), "ranges")
    sources = materialize(sums.groupBy("source", "source_key").agg(F.sum("words").alias("source_size")), "totals")
    targets = materialize(with_targets(sources).select("source_key", "source_size", "target"), "targets")
    below = F.sum("words").over(Window.partitionBy("source_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = materialize(sums.select(*cut, F.coalesce(below, F.lit(0)).alias("offset")).join(targets, "source_key"), "offsets")
    inside = Window.partitionBy(*cut).orderBy("key", "doc_id", "size", "mark").rowsBetween(Window.unboundedPreceding, 0)
    placed = _derived(docs, carry).withColumn("part", part).withColumn("before", F.sum("size").over(inside) - F.col("size")).join(offsets, cut)
    budget = F.round("target").cast("long")
    placed = placed.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    rest = budget - F.col("epochs") * F.col("source_size") - F.col("offset") - F.col("before")
    placed = placed.withColumn("again", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest)))
    taken = F.col("epochs") * F.col("size") + F.col("again")
    return placed.select("row", "size", "source_size", "target", "epochs", "again", taken.alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken for every row.

    ``taken`` counts the words that the mix takes of a document, repeats
    included; per source it adds up to the rounded target. Null texts have size
    0, null sources form a source of their own, rows that share a doc_id are
    ordered by size and content. An empty table gives no rows.
    """
    return plan_mix(docs).select("row.doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: one for each epoch and, for what the budget leaves, one more.

    The document at a source's border is cut after its last word that the
    budget covers. Documents without words take no part of any budget and stay once.
    """
    text = F.col("row.text").cast("string")
    planned = plan_mix(docs, docs.columns)
    # a row for each whole pass and one for the words of the last pass
    whole = F.when(F.col("size") == 0, 1).otherwise(F.col("epochs") + (F.col("again") == F.col("size")).cast("long")).cast("int")
    part = F.when((F.col("again") > 0) & (F.col("again") < F.col("size")), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    copies = planned.withColumn("cut", F.explode(F.concat(F.array_repeat(F.lit(False), whole), part)))
    kept = [F.when(F.col("cut"), F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, F.greatest(F.col("again"), F.lit(1)).cast("int")), " ")).otherwise(text).alias(c)
            if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return copies.select(*kept)


#: the same result in DuckDB, with the production parameters
ORACLE = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 15))::BIGINT AS key
  FROM documents),
ranked AS (
  SELECT source, source_size, CASE (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source)),
total AS (SELECT sum(source_size) * 3 / 2.0 AS t, sum(w) AS w FROM ranked),
filled AS (
  SELECT r.*, 2.0::DOUBLE * r.source_size / r.w AS level, t.t, t.w AS all_w,
         sum(2 * r.source_size) OVER o AS full_words, sum(r.w) OVER o AS full_w
  FROM ranked r, total t WINDOW o AS (ORDER BY 2.0::DOUBLE * r.source_size / r.w)),
levels AS (
  SELECT DISTINCT level AS at_level, (t - full_words)::DOUBLE AS words, (all_w - full_w)::DOUBLE AS left_w FROM filled
  UNION SELECT -1, t::DOUBLE, w::DOUBLE FROM total),
best AS (
  SELECT words, left_w FROM levels l WHERE left_w > 0
  AND NOT EXISTS (SELECT 1 FROM ranked r WHERE 2.0::DOUBLE * r.source_size / r.w > l.at_level AND r.w * l.words / l.left_w >= 2 * r.source_size)
  ORDER BY at_level LIMIT 1),
targets AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, w * words / left_w)::DOUBLE AS target FROM ranked, best),
placed AS (
  SELECT r.*, t.source_size, t.target,
         coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
whole AS (SELECT *, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, round(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM whole
"""
