import math
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from panelwright.functions import chunks as C, text as T
from panelwright.sources.scratch import scratch_root


def test_terms_counted_in_rows_equal_shuffled_counts(spark):
    rows = [(1, "a b a b a"), (2, ""), (3, None), (4, "b"), (4, "b c b"), (None, "a"), (None, "a d"), (5, "é a e é a")]
    df = spark.createDataFrame(rows, "id int, text string")
    toks = F.split("text", " ")
    for low, high in ((1, 1), (1, 2), (2, 2)):
        want = T.term_counts(df, "id", toks, low, high)
        got = T.term_counts(df, "id", toks, low, high, in_rows=True)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_terms_of_single_rows_are_not_shuffled(spark):
    df = spark.range(1000).select("id", F.concat_ws(" ", *[F.md5(F.concat(F.col("id"), F.lit(f":{i}"))) for i in range(50)]).alias("text"))
    counts = T.term_counts(df, "id", F.split("text", " "), 1, 2, in_rows=True)
    alone = next(p for p in str(counts._jdf.queryExecution().optimizedPlan()).split("Union")[1].split("Aggregate") if p)
    assert "LeftAnti" in alone and counts.count() == 1000 * 99


ROWS = [(1, ["a", "b", "a", "b", "a"]), (2, []), (3, None), (4, ["b"]), (4, ["b", "c", "b"]), (None, ["a"]), (None, ["a", "d"]), (5, ["é", "a", "é"]),
        (6, ["a", None, "b"]), (7, ["a b", "c", "a", "b c"]), (8, [None]), (9, ["c" * 300, "é" * 9, "b" * 8])]


def test_packed_counts_equal_rows(spark):
    for rows in (ROWS, [(8, [None])]):
        df = spark.createDataFrame(rows, "id int, toks array<string>").repartition(3)
        for low, high in ((1, 1), (1, 2), (2, 2), (1, 3)):
            want = T.term_counts(df, "id", F.col("toks"), low, high).where("term IS NOT NULL")
            got = C.unpacked(T.term_counts(df, "id", F.col("toks"), low, high, packed=True), "id")
            assert got.schema.simpleString() == want.select("id", "term", "tf").schema.simpleString()
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def plain_weights(counts, n_docs, terms=None):
    counts = [r for r in counts if r["term"] is not None and (terms is None or r["term"] in terms)]
    df = Counter(r["term"] for r in counts)
    raw = {(r["id"], r["term"]): r["tf"] * (math.log((n_docs + 1) / (df[r["term"]] + 1)) + 1) for r in counts}
    norm = Counter()
    for (i, _), w in raw.items():
        norm[i] += w * w
    return {k: round(w / math.sqrt(norm[k[0]]), 9) for k, w in raw.items()}


@pytest.mark.parametrize("part", (C.PART, 4))
def test_tfidf_of_rows_and_of_chunks_with_repeated_ids(spark, monkeypatch, part):
    monkeypatch.setattr(C, "PART", part)  # of 4 n-grams: many parts
    df = spark.createDataFrame(ROWS + [(10 + i, ["a", f"w{i}", f"w{i % 3}"]) for i in range(40)], "id int, toks array<string>").repartition(3)
    n = df.agg(F.count(F.lit(1)).alias("n_docs"))
    rows = T.term_counts(df, "id", F.col("toks"), 1, 2)
    packed = T.term_counts(df, "id", F.col("toks"), 1, 2, packed=True)
    top = {r["term"] for r in T.vocabulary(rows.where("term IS NOT NULL"), 5).collect()}
    for counts in (rows.where("term IS NOT NULL"), packed):
        for cap, terms in ((None, None), (5, top)):
            got = T.tfidf(counts, "id", n, cap).collect()
            assert {(r["id"], r["term"]): round(r["weight"], 9) for r in got} == plain_weights(rows.collect(), df.count(), terms)
            assert len(got) == len({(r["id"], r["term"]) for r in got})


def test_the_norm_of_nothing_is_null(spark):
    counts = spark.createDataFrame([(1, "a", 0)], "id int, term string, tf long")
    n = spark.range(1).select(F.lit(1).alias("n_docs"))
    assert [r["weight"] for r in T.tfidf(counts, "id", n).collect()] == [None]


def test_a_term_is_counted_in_the_same_part_whatever_its_chunk():
    texts = ["", "a", "a b", "é" * 5, "x" * 8, "x" * 9, "y" * 5000]
    for kind in (pa.string(), pa.large_string()):
        want = C._parts(pa.array(texts, kind), 1000)
        assert (C._parts(pa.array(["zz", *texts][::-1], kind)[:-1], 1000) == want[::-1]).all() and len(set(want)) == len(texts)
        assert [C._parts(pa.array([t], kind), 1000)[0] for t in texts] == [*want]


def test_weights_take_less_scratch_than_the_texts(spark, tmp_path):
    words = F.transform(F.sequence(F.lit(1), F.lit(400)), lambda i: F.concat(F.lit("word"), F.pmod(F.xxhash64(F.col("doc_id"), i), F.lit(5000)).cast("string")))
    spark.range(500).withColumnRenamed("id", "doc_id").withColumn("text", F.array_join(words, " ")).write.parquet(f"{tmp_path}/documents.parquet")
    texts = spark.read.parquet(f"{tmp_path}/documents.parquet").agg(F.sum(F.length("text"))).first()[0]
    root = Path(scratch_root(spark).removeprefix("file:"))
    before = {*root.iterdir()}
    assert __spark_entry__.queries()["c13_tfidf"](spark, str(tmp_path)).count() > 300_000
    assert sum(f.stat().st_size for d in {*root.iterdir()} - before for f in d.rglob("*.parquet")) < texts
