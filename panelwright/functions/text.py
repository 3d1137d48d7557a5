"""Text expressions, tokens, n-grams and TF-IDF over whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from panelwright.functions import chunks as C
from panelwright.operators.scale import join_lookup, running_totals
from panelwright.sources.scratch import materialize

# Unicode white space, and a word character (letter, digit or underscore).
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NON_SPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
URL = rf"https?://{NON_SPACE}+|www\.{NON_SPACE}+"
USER = r"@[A-Za-z0-9_]+"
# Ids of the special tokens in encoded pairs.
PAD, UNKNOWN, START, SEPARATOR, FIRST_FREE = 0, 1, 2, 3, 4


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """Regex group, or NULL where the pattern does not match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def extract_int(c: Column, pattern: str, default: int = 0) -> Column:
    """Regex digits as a number, or the default."""
    return F.coalesce(extract(c, pattern).try_cast("bigint"), F.lit(default).cast("bigint"))


def words(c: Column) -> Column:
    """White-space separated tokens as an array."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACE + "+"), lambda w: w != "")


def all_but_last(c: Column, default: str = "NONE") -> Column:
    """All tokens but the last, joined by underscores; the default for a single token."""
    w = words(c)
    return F.when(F.size(w) > 1, F.array_join(F.slice(w, 1, F.size(w) - 1), "_")).otherwise(F.lit(default))


def clean_text(c: Column) -> Column:
    """Lower case, without URLs and user mentions, white space collapsed and trimmed."""
    out = F.regexp_replace(F.lower(c), URL, "")
    out = F.regexp_replace(out, USER, "")
    return F.trim(F.regexp_replace(out, SPACE + "+", " "))


def join_pair(first: Column, second: Column, separator: str = " [SEP] ") -> Column:
    """Both texts around a separator; NULL if either is NULL."""
    return F.concat(first, F.lit(separator), second)


def tokens(c: Column, min_chars: int = 2, stop_words: Sequence[str] = ()) -> Column:
    """Lower-cased word tokens of at least ``min_chars`` characters without stop words."""
    found = F.regexp_extract_all(F.lower(c), F.lit(f"{WORD}{{{min_chars},}}"), F.lit(0))
    return F.filter(found, lambda w: ~w.isin(*stop_words)) if stop_words else found


def english_stop_words(spark: SparkSession) -> list[str]:
    """The English list that ships with Spark; pass another list where a query needs one."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


def ngrams(toks: Column, low: int = 1, high: int = 2) -> Column:
    """All n-grams of ``low`` to ``high`` tokens as one array.

    ``toks`` should be a plain column: an expression would be evaluated again for every use.
    """
    grams, out = toks, [toks] if low == 1 else []
    for n in range(2, high + 1):
        rest = F.greatest(F.size(toks) - (n - 1), F.lit(0))
        grams = F.zip_with(F.slice(grams, F.lit(1), rest), F.slice(toks, F.lit(n), rest),
                           lambda a, b: F.concat(a, F.lit(" "), b))
        if n >= low:
            out.append(grams)
    return out[0] if len(out) == 1 else F.concat(*out)


def term_counts(df: DataFrame, id_col: str, toks: Column, low: int = 1, high: int = 1, in_rows: bool = False, packed: bool = False) -> DataFrame:
    """One row per (id, n-gram) with the term frequency ``tf``; the tokens are computed once per row.

    ``in_rows`` is for a table whose ids mostly name one row: its terms are counted
    inside the row and never shuffled. Only ids of several rows (NULL is an id too),
    found by one aggregation over the ids, are counted by a shuffle of their terms.

    ``packed`` writes the same counts as chunks of some 500,000 tokens for ``tfidf``;
    ``chunks.unpacked`` gives their rows, without those of a NULL term.
    """
    if not in_rows and not packed:
        return _shuffled_counts(df, id_col, toks, low, high)
    several = materialize(df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(id_col).alias("_several")), "several-rows")
    same = F.col(id_col).eqNullSafe(F.col("_several"))
    alone, others = df.join(several, same, "left_anti"), _shuffled_counts(df.join(several, same, "left_semi"), id_col, toks, low, high)
    if not packed:
        return _row_counts(alone, id_col, toks, low, high).unionByName(others)
    streams = C.pack_streams(alone.select(id_col, toks.alias("_toks")), id_col, "_toks", low, high)
    with C.small_batches(df.sparkSession, 256):
        return materialize(streams.unionByName(C.pack_counts(others, id_col)), "term-chunks")


def _shuffled_counts(df: DataFrame, id_col: str, toks: Column, low: int, high: int) -> DataFrame:
    return df.select(id_col, toks.alias("_toks")).select(
        id_col, F.explode(ngrams(F.col("_toks"), low, high)).alias("term")
    ).groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def _row_counts(df: DataFrame, id_col: str, toks: Column, low: int, high: int) -> DataFrame:
    """Term counts of each row: its sorted n-grams are cut where the term changes."""
    ordered = df.select(id_col, toks.alias("_toks")).select(id_col, F.sort_array(ngrams(F.col("_toks"), low, high)).alias("_terms"))
    cuts = F.filter(F.transform("_terms", lambda t, i: F.when((i == 0) | (t != F.get("_terms", i - 1)), i)), lambda i: i.isNotNull())
    runs = ordered.select(id_col, "_terms", cuts.alias("_cuts")).select(id_col, F.explode(F.transform("_cuts", lambda at, j: F.struct(
        F.get("_terms", at).alias("term"), (F.coalesce(F.get("_cuts", j + 1), F.size("_terms")) - at).cast("long").alias("tf")))).alias("_run"))
    return runs.select(id_col, "_run.term", "_run.tf")


def vocabulary(counts: DataFrame, cap: int | None = None) -> DataFrame:
    """All terms of the corpus with document frequency ``df``, or the ``cap`` most frequent (ties by term)."""
    terms = counts.groupBy("term").agg(F.sum("tf").alias("corpus_tf"), F.count(F.lit(1)).alias("df"))
    return terms if cap is None else terms.orderBy(F.col("corpus_tf").desc(), "term").limit(cap)


def tfidf(counts: DataFrame, id_col: str, n_docs: DataFrame, cap: int | None = None) -> DataFrame:
    """L2-normalised TF-IDF weights with smoothed idf over all terms, or over the ``cap`` most frequent.

    ``counts`` are rows or packed; ``n_docs`` is a one-row frame with ``n_docs``. The
    terms of a chunk meet their document frequencies there. The norm of a document
    that one chunk holds is taken in it, that of others over their rows.
    """
    spark = counts.sparkSession
    if cap is not None:
        counts = materialize(C.unpacked(counts, id_col) if C.is_packed(counts) else counts, "term-counts")
        counts = counts.join(vocabulary(counts, cap).select("term"), "term", "left_semi")
    if not C.is_packed(counts):
        with C.small_batches(spark, 4096):
            counts = materialize(C.pack_counts(counts, id_col), "term-chunks")
    done, raw = C.weights(counts, id_col, n_docs.first()["n_docs"], "weight")
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col)))
    return done.unionByName(raw.select(id_col, "term", F.try_divide("raw", norm).alias("weight")))


def top_words(df: DataFrame, label: str, terms: Column, k: int) -> DataFrame:
    """The ``k`` most frequent words per label; Spark cuts each partition to k rows before the shuffle."""
    counts = df.select(label, F.explode(terms).alias("word")).groupBy(label, "word").agg(
        F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(label).orderBy(F.col("n").desc(), "word")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ids_of(vocab: DataFrame) -> DataFrame:
    """Dense ids for all terms of a vocabulary, most frequent first (ties by term), after the special tokens.

    Terms of one frequency are cut by their leading characters, so no task
    numbers all of them: sums of the cuts give each its offset.
    """
    cut = materialize(vocab.select("term", "corpus_tf", F.substring("term", 1, 3).alias("_lead")), "vocabulary")
    sizes = cut.groupBy("corpus_tf", "_lead").agg(F.count(F.lit(1)).alias("_n"))
    above = running_totals(sizes.groupBy("corpus_tf").agg(F.sum("_n").alias("_all")), "corpus_tf", ["_all"]).select(
        "corpus_tf", (F.col("tot__all") - F.col("cum__all")).alias("_above"))
    before = Window.partitionBy("corpus_tf").orderBy("_lead").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("corpus_tf", "_lead", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).join(above, "corpus_tf")
    inside = F.row_number().over(Window.partitionBy("corpus_tf", "_lead").orderBy("term"))
    numbered = cut.withColumn("_no", inside).join(offsets, ["corpus_tf", "_lead"]).select(
        "term", "corpus_tf", (F.col("_above") + F.col("_before") + F.col("_no") + (FIRST_FREE - 1)).cast("long").alias("token_id"))
    return materialize(numbered, "token-ids")


def encode_pairs(df: DataFrame, id_cols: Sequence[str], first: Column, second: Column, vocab: DataFrame,
                 max_len: int) -> DataFrame:
    """Fixed-length ids, attention mask and segment ids of token pairs.

    ``first`` and ``second`` are token arrays; the longer one is truncated first.
    ``vocab`` is a frame of (term, corpus_tf, token_id) of any size. The pairs are
    exploded once, and the ids are collected with the lengths.
    """
    ids = list(id_cols)
    room = max_len - 3
    base = df.select(*ids, first.alias("_a"), second.alias("_b"))
    keep_a = F.least(F.size("_a"), F.greatest(room - F.size("_b"), F.lit((room + 1) // 2)))
    base = base.withColumn("_na", keep_a).withColumn("_nb", F.least(F.size("_b"), F.lit(room) - F.col("_na")))
    both = F.concat(F.slice("_a", F.lit(1), F.col("_na")), F.slice("_b", F.lit(1), F.col("_nb")))
    # a pair without tokens keeps its row, with a term that no vocabulary has
    flat = base.select(*ids, "_na", "_nb", F.posexplode_outer(both).alias("_pos", "term"))
    coded = join_lookup(flat, vocab.where(F.col("term").isNotNull()), ["term"], "corpus_tf", [*ids, "_pos"]).groupBy(*ids).agg(
        F.first("_na").alias("_na"), F.first("_nb").alias("_nb"),
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.coalesce(F.col("token_id").cast("int"), F.lit(UNKNOWN)).alias("t"))))),
            lambda s: s["t"]).alias("_ids"))
    one = F.array(F.lit(SEPARATOR))
    seq = F.concat(F.array(F.lit(START)), F.slice("_ids", F.lit(1), F.col("_na")), one,
                   F.slice("_ids", F.col("_na") + 1, F.col("_nb")), one)
    used, head = F.col("_na") + F.col("_nb") + 3, F.col("_na") + 2
    pad = F.lit(max_len) - used
    return coded.select(
        *ids,
        F.concat(seq, F.array_repeat(F.lit(PAD), pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), pad)).alias("attention_mask"),
        F.concat(F.array_repeat(F.lit(0), head), F.array_repeat(F.lit(1), F.col("_nb") + 1),
                 F.array_repeat(F.lit(0), pad)).alias("segment_ids"))


def pack_by_budget(df: DataFrame, batch: str, position: str, id_col: str, n_tokens: str, budget: int) -> DataFrame:
    """Greedy micro-batches under a token budget inside each loader batch, in position order.

    A loader batch has a fixed number of rows, so its array is bounded. A row
    that exceeds the budget on its own forms its own micro-batch.
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col(position).alias("pos"), F.col(id_col).alias("id"),
                                                F.col(n_tokens).cast("bigint").alias("tok"))))
    start = F.struct(F.lit(0).alias("pack"), F.lit(0).cast("bigint").alias("used"),
                     F.array().cast("array<int>").alias("packs"))

    def step(acc, row):
        full = (acc["used"] > 0) & (acc["used"] + row["tok"] > budget)
        pack = F.when(full, acc["pack"] + 1).otherwise(acc["pack"])
        used = F.when(full, row["tok"]).otherwise(acc["used"] + row["tok"])
        return F.struct(pack.alias("pack"), used.alias("used"),
                        F.concat(acc["packs"], F.array(pack)).alias("packs"))

    grouped = df.groupBy(batch).agg(rows.alias("_rows")).withColumn(
        "_packs", F.aggregate("_rows", start, step)["packs"])
    return grouped.select(batch, F.explode(F.arrays_zip("_rows", "_packs")).alias("z")).select(
        F.col(batch), F.col("z._packs").alias("pack"), F.col("z._rows.pos").alias(position),
        F.col("z._rows.id").alias(id_col), F.col("z._rows.tok").alias(n_tokens))
