import hashlib
import random
import re

import __spark_entry__
import oracle_check
import pytest
from conftest import SF

from panelwright.llm import exact_dedup
from panelwright.llm.exact_dedup import PatriciaTrie


def brute(rows):
    """doc_id, keep_id, group_size, kept, sha of each (doc_id, text) row, by plain grouping."""
    groups = {}
    for i, (doc, text) in enumerate(rows):
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(norm, []).append((-len(text or ""), doc is None, doc or 0, i, doc))
    out = []
    for norm, members in groups.items():
        best = min(members)
        for m in members:
            out.append((m[4], best[4], len(members), m is best, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in exact_dedup.exact_duplicates(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_equals_oracle(spark, sf):
    query, sql = __spark_entry__.queries()["op13_exact_dedup"], __spark_entry__.oracle_sql()["op13_exact_dedup"]
    assert oracle_check.compare(query(spark, sf), oracle_check.duck(sf), sql) is None


def test_messy_rows(messy, messy_rows):
    """Nulls, blanks, repeated rows and ids, very long texts and clashing columns."""
    assert got(messy) == brute([(r[0], r[1]) for r in messy_rows])


def test_empty_table(empty):
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_a_third_of_rows_are_copies(spark):
    rows = [(i, ("same  text\n" if i % 3 == 0 else f"text {i}") + (" " * (i % 2))) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    result = got(df)
    assert result == brute(rows)
    assert sum(1 for r in result if r[2] == 1000 and r[3]) == 1


def test_ties_on_length_and_id_keep_one_row(spark):
    rows = [(5, "a b"), (5, "a b"), (4, "ab"), (None, "a  b"), (None, "a  b")]
    result = got(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    assert sum(r[3] for r in result) == 1 and {r[1] for r in result} == {None}


def test_trie_keeps_prefixes_apart():
    rng = random.Random(3)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    trie, nodes = PatriciaTrie(), {}
    for k in keys:
        node = trie.terminal(k)
        if node.value is None:
            node.value = k
        assert node.value == k
        nodes[k] = node
    assert sorted(n.value for n in trie.terminals()) == sorted(set(keys))
    assert all(trie.terminal(k) is nodes[k] for k in keys)
