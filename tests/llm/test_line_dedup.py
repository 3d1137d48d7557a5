import random

import pytest
from conftest import words
from pyspark.sql import functions as F

from panelwright.llm import line_dedup


def brute(rows):
    """Removed line numbers of (doc_id, text) rows with distinct ids, by comparing every pair."""
    lines = [(i, k, frozenset(x.encode().lower().split())) for i, t in sorted(rows) for k, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    gone = {}
    for at, (i, k, own) in enumerate(lines):
        for _, _, other in lines[:at]:
            if 5 * len(own & other) >= 4 * len(own | other):
                gone.setdefault(i, []).append(k)
                break
    return gone, {i: sum(1 for x in lines if x[0] == i) for i, _ in rows}


def compare(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    gone, n = brute(rows)
    got = line_dedup.dedupe_lines(docs).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["removed_lines"]) for r in got} == {
        i: (n[i], len(gone.get(i, [])), ",".join(map(str, gone.get(i, [])))) for i, _ in rows}


def near_lines(seed, groups=6, copies=25):
    """Groups of lines that differ in a few words, and lines that fall just below the threshold."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = words(rng.choice([4, 5, 9, 20, 60, 150, 400]), 100 * seed + g).split()
        for c in range(copies):
            own = base[:]
            for _ in range(rng.randrange(1 + len(base) // 8)):
                own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
            rng.shuffle(own)
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return [(k, "\n".join(rows[i : i + 3])) for k, i in enumerate(range(0, len(rows), 3))]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_lines_equal_brute_force(spark, seed):
    compare(spark.createDataFrame(near_lines(seed), "doc_id long, text string").repartition(4))


def test_lines_with_many_failing_candidates(spark, monkeypatch):
    monkeypatch.setattr(line_dedup._Group, "similar", lambda self, x, y: __import__("numpy").arange(len(x)))
    compare(spark.createDataFrame(near_lines(3, 5, 12), "doc_id long, text string").repartition(3))


def test_documents_equal_brute_force(documents):
    compare(documents.where("n_chars < 4000").limit(120))


def test_messy_rows(messy, messy_rows):
    compare(messy.where("doc_id is not null and doc_id != 9223372036854775807").dropDuplicates(["doc_id"]))
    assert line_dedup.dedupe_lines(messy).count() == len(messy_rows)


def test_empty_table(empty):
    assert line_dedup.dedupe_lines(empty).count() == 0 and line_dedup.without_repeats(empty).count() == 0


def test_without_repeats_edits_the_texts(messy):
    plain = messy.where("doc_id is not null and doc_id != 9223372036854775807").dropDuplicates(["doc_id"])
    gone, n = brute([(r["doc_id"], r["text"]) for r in plain.collect()])
    got = line_dedup.without_repeats(plain)
    assert got.columns == plain.columns
    want = {}
    for r in plain.collect():
        drop = gone.get(r["doc_id"], [])
        if not (drop and len(drop) == n[r["doc_id"]]):
            want[r["doc_id"]] = r["text"] if r["text"] is None else "\n".join(x for k, x in enumerate(r["text"].split("\n")) if k not in drop)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want


def test_a_third_of_all_lines_alike(spark):
    rows = [(i, "the very same line of eight common words\n" + words(12, i)) for i in range(120)]
    got = line_dedup.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string")).agg(F.sum("n_removed")).first()[0]
    assert got == 119
