"""String, text and date plans."""

from pyspark.sql import functions as F

from panelwright.functions import calendar as K, text as T
from panelwright.operators.panel import dense_daily
from panelwright.operators.scale import numbered_by_hash
from panelwright.plans.registry import day_text, plan, rounded
from panelwright.sources.tables import scan, spread

SPACE, NON_SPACE, WORD = T.SPACE, T.NON_SPACE, T.WORD
# A short stop list that both engines get.
STOP = ("the", "and", "of", "to", "in", "is", "le", "la", "de", "der", "die", "und", "el", "que", "en")
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
TOKENS_SQL = f"list_filter(regexp_extract_all(lower(text), '{WORD}{{2,}}'), lambda w: w NOT IN ({STOP_SQL}))"


@plan("c1_regex_extract", r"""
SELECT c_custkey, nullif(regexp_extract(c_name, '(\d+)', 1), '') AS first_digits,
       CAST(coalesce(TRY_CAST(nullif(regexp_extract(c_name, '(\d+)$', 1), '') AS BIGINT), 0) AS BIGINT) AS trailing_number,
       nullif(regexp_extract(c_mktsegment || '+' || CAST(c_nationkey AS VARCHAR), '([+-]\d+)$', 1), '') AS signed_offset,
       nullif(regexp_extract('Name, ' || c_mktsegment || '. rest', ',\s*([^\.]+)\.', 1), '') AS title,
       nullif(regexp_extract(c_mktsegment, '(\d+)', 1), '') AS no_match
FROM customer""")
def regex_extract(spark, sf):
    seg, name = F.col("c_mktsegment"), F.col("c_name")
    return scan(spark, sf, "customer").select(
        "c_custkey", T.extract(name, r"(\d+)").alias("first_digits"),
        T.extract_int(name, r"(\d+)$").alias("trailing_number"),
        T.extract(F.concat(seg, F.lit("+"), F.col("c_nationkey").cast("string")), r"([+-]\d+)$").alias("signed_offset"),
        T.extract(F.concat(F.lit("Name, "), seg, F.lit(". rest")), r",\s*([^\.]+)\.").alias("title"),
        T.extract(seg, r"(\d+)").alias("no_match"))


URL_PARTS = r"^(https?)://([^/]+)/([a-z]+)/(\d+)"


@plan("c2_multi_group_parse", f"""
SELECT page_id, nullif(regexp_extract(url, '{URL_PARTS}', 1), '') AS scheme,
       nullif(regexp_extract(url, '{URL_PARTS}', 2), '') AS host,
       nullif(regexp_extract(url, '{URL_PARTS}', 3), '') AS lang,
       TRY_CAST(nullif(regexp_extract(url, '{URL_PARTS}', 4), '') AS BIGINT) AS number FROM pages""")
def multi_group(spark, sf):
    u = F.col("url")
    return scan(spark, sf, "pages").select(
        "page_id", *[T.extract(u, URL_PARTS, i).alias(n) for i, n in ((1, "scheme"), (2, "host"), (3, "lang"))],
        T.extract(u, URL_PARTS, 4).try_cast("bigint").alias("number"))


@plan("c3_split_first_last", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, split_part(p_name, ' ', -1) AS last_word FROM part""")
def split_ends(spark, sf):
    return scan(spark, sf, "part").select(
        "p_partkey", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("first_word"),
        F.try_element_at(T.words(F.col("p_name")), F.lit(-1)).alias("last_word"))


@plan("c4_token_count", f"""
SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '{SPACE}+'), lambda w: w <> '')) AS BIGINT) AS n_tokens,
       CAST(length(text) AS BIGINT) AS n_text_chars FROM documents""")
def token_count(spark, sf):
    return spread(scan(spark, sf, "documents")).select(
        "doc_id", F.size(T.words(F.col("text"))).cast("bigint").alias("n_tokens"),
        F.char_length("text").cast("bigint").alias("n_text_chars"))


@plan("c5_all_but_last", """
SELECT p_partkey, CASE WHEN len(w) > 1 THEN array_to_string(w[1:len(w) - 1], '_') ELSE 'NONE' END AS head,
       CASE WHEN len(v) > 1 THEN array_to_string(v[1:len(v) - 1], '_') ELSE 'NONE' END AS head_type
FROM (SELECT p_partkey, string_split(p_name || ' ' || p_brand, ' ') AS w, string_split(p_type, ' ') AS v FROM part)""")
def head_tokens(spark, sf):
    return scan(spark, sf, "part").select(
        "p_partkey", T.all_but_last(F.concat_ws(" ", "p_name", "p_brand")).alias("head"),
        T.all_but_last(F.col("p_type")).alias("head_type"))


@plan("c6_first_character", """
SELECT c_custkey, coalesce(substr(CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END, 1, 1), 'Missing') AS deck FROM customer""")
def first_character(spark, sf):
    seg = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment"))
    return scan(spark, sf, "customer").select(
        "c_custkey", F.coalesce(F.substring(seg, 1, 1), F.lit("Missing")).alias("deck"))


@plan("c7_regex_replace", r"""
SELECT o_orderkey, trim(regexp_replace(regexp_replace('Puente ' || o_orderpriority || '+' || (o_orderkey % 4),
         '^\s*(Traslado|Puente)\s+', '', 'i'), '[+-]\d+$', '')) AS cleaned FROM orders""")
def regex_replace(spark, sf):
    raw = F.concat(F.lit("Puente "), "o_orderpriority", F.lit("+"), (F.col("o_orderkey") % 4).cast("string"))
    out = F.regexp_replace(F.regexp_replace(raw, r"(?i)^\s*(Traslado|Puente)\s+", ""), r"[+-]\d+$", "")
    return scan(spark, sf, "orders").select("o_orderkey", F.trim(out).alias("cleaned"))


@plan("c8_regex_contains", """
SELECT doc_id, coalesce(regexp_matches(CASE WHEN doc_id % 6 <> 0 THEN text END, '(?i)tion|[eé]lle'), false) AS hit FROM documents""")
def regex_contains(spark, sf):
    maybe = F.when(F.col("doc_id") % 6 != 0, F.col("text"))
    return spread(scan(spark, sf, "documents")).select(
        "doc_id", F.coalesce(F.rlike(maybe, F.lit("(?i)tion|[eé]lle")), F.lit(False)).alias("hit"))


CLEAN_SQL = f"""trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '{T.URL}', '', 'g'), '{T.USER}', '', 'g'),
  '{SPACE}+', ' ', 'g'))"""


@plan("c9_clean_text", f"""
SELECT 'doc' AS kind, doc_id AS id, 0::BIGINT AS part, md5({CLEAN_SQL}) AS clean_md5, CAST(length({CLEAN_SQL}) AS BIGINT) AS n
FROM documents UNION ALL
SELECT 'turn', conv_id, turn, md5({CLEAN_SQL}), CAST(length({CLEAN_SQL}) AS BIGINT) FROM conversations""")
def clean(spark, sf):
    docs = spread(scan(spark, sf, "documents")).select(
        F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("part"), "text")
    turns = scan(spark, sf, "conversations").select(
        F.lit("turn").alias("kind"), F.col("conv_id").alias("id"), F.col("turn").alias("part"), "text")
    c = T.clean_text(F.col("text"))
    return docs.unionByName(turns).select("kind", "id", "part", F.md5(c).alias("clean_md5"),
                                          F.char_length(c).cast("bigint").alias("n"))


def conversation_pairs(spark, sf):
    """User turns with the assistant turn that follows; (conv_id, turn) is a unique key, so no key is hot."""
    c = scan(spark, sf, "conversations")
    user = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("premise"))
    reply = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("hypothesis"))
    return user.join(reply, ["conv_id", "turn"])


PAIRS_SQL = """(SELECT u.conv_id, u.turn, u.text AS premise, a.text AS hypothesis FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant')"""


@plan("c10_join_pair", f"SELECT conv_id, turn, premise || ' [SEP] ' || hypothesis AS pair_text FROM {PAIRS_SQL}")
def pair_join(spark, sf):
    return conversation_pairs(spark, sf).select(
        "conv_id", "turn", T.join_pair(F.col("premise"), F.col("hypothesis")).alias("pair_text"))


@plan("c11_tokens_without_stop_words", f"""
SELECT doc_id, CAST(len({TOKENS_SQL}) AS BIGINT) AS n_tokens, md5(array_to_string({TOKENS_SQL}, ' ')) AS tokens_md5,
       CAST(len(regexp_extract_all(lower(text), '{WORD}+')) AS BIGINT) AS n_all FROM documents""")
def stop_tokens(spark, sf):
    t = T.tokens(F.col("text"), 2, STOP)
    return spread(scan(spark, sf, "documents")).select(
        "doc_id", F.size(t).cast("bigint").alias("n_tokens"), F.md5(F.array_join(t, " ")).alias("tokens_md5"),
        F.size(T.tokens(F.col("text"), 1)).cast("bigint").alias("n_all"))


TERMS_SQL = f"""(SELECT doc_id, unnest(list_concat(t, list_transform(range(1, greatest(len(t), 1)), lambda i: t[i] || ' ' || t[i + 1])))
  AS term FROM (SELECT doc_id, {TOKENS_SQL} AS t FROM documents))"""


@plan("c12_ngrams", f"SELECT doc_id, count(*) AS n_terms, count(DISTINCT term) AS n_distinct FROM {TERMS_SQL} GROUP BY doc_id")
def ngram_counts(spark, sf):
    counts = T.term_counts(spread(scan(spark, sf, "documents")), "doc_id", T.tokens(F.col("text"), 2, STOP), 1, 2, in_rows=True)
    return counts.groupBy("doc_id").agg(F.sum("tf").alias("n_terms"), F.count(F.lit(1)).alias("n_distinct"))


@plan("c13_tfidf", f"""
WITH c AS (SELECT doc_id, term, count(*) AS tf FROM {TERMS_SQL} GROUP BY ALL),
v AS (SELECT term, count(*) AS df FROM c GROUP BY term),
r AS (SELECT doc_id, c.term, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1) AS raw FROM c JOIN v USING (term))
SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) + 0.0 AS weight FROM r""")
def tfidf(spark, sf):
    docs = scan(spark, sf, "documents")
    counts = T.term_counts(spread(docs), "doc_id", T.tokens(F.col("text"), 2, STOP), 1, 2, packed=True)
    n = docs.agg(F.count(F.lit(1)).alias("n_docs"))  # from the file footers
    return T.tfidf(counts, "doc_id", n).select("doc_id", "term", rounded("weight", 6).alias("weight"))


@plan("c14_words_per_class", f"""
WITH w AS (SELECT quality, unnest({TOKENS_SQL}) AS word FROM documents JOIN labels USING (doc_id)),
c AS (SELECT quality, word, count(*) AS n FROM w GROUP BY ALL)
SELECT quality, word, n, CAST(row_number() OVER (PARTITION BY quality ORDER BY n DESC, word) AS INTEGER) AS rank FROM c
QUALIFY rank <= 20""")
def class_words(spark, sf):
    docs = spread(scan(spark, sf, "documents")).join(scan(spark, sf, "labels"), "doc_id")
    return T.top_words(docs, "quality", T.tokens(F.col("text"), 2, STOP), 20)


@plan("c15_encode_pairs", f"""
WITH p AS (SELECT conv_id, turn, regexp_extract_all(lower(premise), '{WORD}+') AS a,
                  regexp_extract_all(lower(hypothesis), '{WORD}+') AS b FROM {PAIRS_SQL}),
v AS (SELECT term, 3 + row_number() OVER (ORDER BY n DESC, term) AS id FROM
      (SELECT term, count(*) AS n FROM (SELECT unnest(list_concat(a, b)) AS term FROM p) GROUP BY term)),
k AS (SELECT *, least(len(a), greatest(61 - len(b), 31)) AS na FROM p),
k2 AS (SELECT *, least(len(b), 61 - na) AS nb FROM k),
f AS (SELECT conv_id, turn, na, nb, unnest(list_concat(a[1:na], b[1:nb])) AS term, unnest(range(1, na + nb + 1)) AS pos FROM k2),
i AS (SELECT conv_id, turn, list(coalesce(id, 1) ORDER BY pos) AS ids FROM f LEFT JOIN v USING (term) GROUP BY conv_id, turn)
SELECT conv_id, turn,
  array_to_string(list_concat([2], coalesce(ids, [])[1:na], [3], coalesce(ids, [])[na + 1:na + nb], [3],
    list_transform(range(0, 61 - na - nb), lambda x: 0)), ',') AS input_ids,
  array_to_string(list_transform(range(0, 64), lambda x: CASE WHEN x < na + nb + 3 THEN 1 ELSE 0 END), ',') AS attention_mask,
  array_to_string(list_transform(range(0, 64), lambda x: CASE WHEN x >= na + 2 AND x < na + nb + 3 THEN 1 ELSE 0 END), ',') AS segment_ids
FROM k2 LEFT JOIN i USING (conv_id, turn)""")
def encoded_pairs(spark, sf):
    pairs = conversation_pairs(spark, sf)
    a, b = T.tokens(F.col("premise"), 1), T.tokens(F.col("hypothesis"), 1)
    counts = T.term_counts(pairs.withColumn("_id", F.concat_ws(":", "conv_id", "turn")), "_id", F.concat(a, b))
    vocab = T.ids_of(T.vocabulary(counts))
    out = T.encode_pairs(pairs, ["conv_id", "turn"], a, b, vocab, 64)
    return out.select("conv_id", "turn", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
                                           for c in ("input_ids", "attention_mask", "segment_ids")])


@plan("c16_token_budget_packing", f"""
WITH RECURSIVE t AS (
  SELECT doc_id, len(regexp_extract_all(text, '{WORD}+')) AS tok,
         row_number() OVER (ORDER BY md5(concat_ws(':', '0', CAST(doc_id AS VARCHAR))), doc_id) - 1 AS p FROM documents),
b AS (SELECT doc_id, tok, p // 80 AS batch, p % 80 AS pos FROM t),
r AS (SELECT batch, pos, doc_id, tok, tok AS used, 0 AS pack FROM b WHERE pos = 0
      UNION ALL
      SELECT b.batch, b.pos, b.doc_id, b.tok, CASE WHEN r.used > 0 AND r.used + b.tok > 8192 THEN b.tok ELSE r.used + b.tok END,
             CASE WHEN r.used > 0 AND r.used + b.tok > 8192 THEN r.pack + 1 ELSE r.pack END
      FROM r JOIN b ON b.batch = r.batch AND b.pos = r.pos + 1)
SELECT CAST(batch AS BIGINT) AS batch, CAST(pack AS INTEGER) AS pack, CAST(pos AS BIGINT) AS pos, doc_id, CAST(tok AS BIGINT) AS tok FROM r""")
def packing(spark, sf):
    docs = spread(scan(spark, sf, "documents")).select(
        "doc_id", F.size(F.regexp_extract_all("text", F.lit(WORD + "+"), F.lit(0))).alias("tok"))
    rows = numbered_by_hash(docs, ["doc_id"], out="rn")
    p = F.col("rn") - 1
    placed = rows.select("doc_id", "tok", F.floor(p / 80).alias("batch"), (p % 80).alias("pos"))
    return T.pack_by_budget(placed, "batch", "pos", "doc_id", "tok", 8192)


@plan("d1_to_day", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def to_day(spark, sf):
    return scan(spark, sf, "orders").select("o_orderkey", day_text(F.to_date("o_orderdate")).alias("day"))


@plan("d2_dense_daily_grid", """
WITH d AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS v FROM orders GROUP BY ALL),
g AS (SELECT series, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d GROUP BY series)
SELECT g.series, strftime(g.day, '%Y-%m-%d') AS day, round(v, 2) + 0.0 AS v FROM g LEFT JOIN d USING (series, day)""")
def dense_grid(spark, sf):
    daily = scan(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("v"))
    return dense_daily(daily, ["series"], "day").select("series", day_text("day").alias("day"), rounded("v", 2).alias("v"))


@plan("d3_calendar_parts", """
SELECT o_orderkey, CAST(week(o_orderdate) AS INTEGER) AS iso_week, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday,
       CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year, CAST(dayofyear(o_orderdate) = 1 AS INTEGER) AS new_year FROM orders""")
def calendar_parts(spark, sf):
    d = F.col("o_orderdate")
    return scan(spark, sf, "orders").select(
        "o_orderkey", F.weekofyear(d).alias("iso_week"), F.weekday(d).alias("weekday"),
        F.dayofyear(d).alias("day_of_year"), (F.dayofyear(d) == 1).cast("int").alias("new_year"))


@plan("d4_resample", """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS v FROM orders GROUP BY ALL),
k AS (SELECT 'W-SUN' AS rule, CAST(date_trunc('week', day) + INTERVAL 6 DAY AS DATE) AS bucket, v FROM d
      UNION ALL SELECT 'M', last_day(day), v FROM d
      UNION ALL SELECT 'Q', CAST(date_trunc('quarter', day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE), v FROM d)
SELECT rule, strftime(bucket, '%Y-%m-%d') AS bucket, round(avg(v), 4) + 0.0 AS mean_v, round(quantile_cont(v, 0.5), 4) + 0.0 AS median_v
FROM k GROUP BY rule, bucket""")
def resample(spark, sf):
    # a bucket holds at most 92 daily values after the daily sum, so the built-in percentile is bounded
    daily = scan(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("v"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), K.resample_key(F.col("day"), r).alias("bucket"))
                                for r in ("W-SUN", "M", "Q")]))
    return daily.select("v", rules.alias("k")).groupBy("k.rule", day_text("k.bucket").alias("bucket")).agg(
        rounded(F.avg("v")).alias("mean_v"), rounded(F.percentile("v", 0.5)).alias("median_v"))


@plan("d5_future_days", """
SELECT strftime(day, '%Y-%m-%d') AS day, day > hi AS is_future FROM (
  SELECT CAST(unnest(generate_series(min(d), max(d) + 16, INTERVAL 1 DAY)) AS DATE) AS day, max(d) AS hi
  FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders))""")
def future_days(spark, sf):
    orders = scan(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    return K.day_range(orders, "day", 16).select(day_text("day").alias("day"), "is_future")


@plan("d6_design_matrix", """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo, hi + 16, INTERVAL 1 DAY)) AS DATE) AS day, lo FROM b),
p AS (SELECT day, CAST(day - lo + 1 AS DOUBLE) AS t, (day - lo) % 7 + 1 AS s,
  (day - CAST(date_trunc('year', day) AS DATE)) / CAST(CAST(date_trunc('year', day) + INTERVAL 1 YEAR AS DATE) - CAST(date_trunc('year', day) AS DATE) AS DOUBLE) AS pa,
  (day - CAST(date_trunc('month', day) AS DATE)) / CAST(CAST(date_trunc('month', day) + INTERVAL 1 MONTH AS DATE) - CAST(date_trunc('month', day) AS DATE) AS DOUBLE) AS pm
  FROM d)
SELECT strftime(day, '%Y-%m-%d') AS day, t AS trend, t * t AS trend_squared,
  CAST(s = 1 AS DOUBLE) AS s_1_7, CAST(s = 4 AS DOUBLE) AS s_4_7, CAST(s = 7 AS DOUBLE) AS s_7_7,
  round(sin(2 * pi() * pa), 6) + 0.0 AS sin_1_A, round(cos(2 * pi() * pa), 6) + 0.0 AS cos_1_A,
  round(sin(4 * pi() * pa), 6) + 0.0 AS sin_2_A, round(cos(4 * pi() * pa), 6) + 0.0 AS cos_2_A,
  round(sin(2 * pi() * pm), 6) + 0.0 AS sin_1_M, round(cos(2 * pi() * pm), 6) + 0.0 AS cos_1_M FROM p""")
def design_matrix(spark, sf):
    orders = scan(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    days = K.day_range(orders, "day", 16).join(F.broadcast(orders.agg(F.min("day").alias("lo"))))
    cols = K.design_columns(F.col("day"), F.col("lo"), 2, weekly=True, freq="A", fourier_order=2)
    cols |= K.fourier(F.col("day"), "M", 1)
    keep = ["trend", "trend_squared", "s_1_7", "s_4_7", "s_7_7"]
    waves = ["sin_1_A", "cos_1_A", "sin_2_A", "cos_2_A", "sin_1_M", "cos_1_M"]
    return days.select(day_text("day").alias("day"), *[cols[c].alias(c) for c in keep],
                       *[rounded(cols[c], 6).alias(c) for c in waves])
