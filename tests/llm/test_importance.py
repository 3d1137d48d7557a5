import hashlib
import math
import re
import zlib

import numpy as np
from conftest import SF

from panelwright.llm import importance
from panelwright.sources.scratch import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UP = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = re.findall(WORD, (text or "").translate(UP))
    return [" ".join(words[i:i + g]) for g in (1, 2, 3) for i in range(len(words) - g + 1)], len(words)


def brute(docs, bench):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = np.zeros(10000, np.int64), np.zeros(10000, np.int64)
    for _, text in docs:
        for f in features(text)[0]:
            s[bucket(f)] += 1
    for text in bench:
        for f in features(text)[0]:
            t[bucket(f)] += 1
    S, T = s.sum(), t.sum()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows = []
    for doc, text in docs:
        fs, n = features(text)
        weight = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    eligible = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    k = 5 * len(eligible) // 100
    ranks = {id(r): i + 1 for i, r in enumerate(eligible[:k])}
    return sorted(((r[0], r[1], r[2], r[3], ranks.get(id(r))) for r in rows), key=repr)


def test_composed_crcs_equal_hashing():
    text = "Alpha beta GAMMA déjà vu 42 xéy über-alles a"
    crcs, lens = importance._payload_streams([text])[0]
    fs = features(text)[0]
    assert list(importance.feature_crcs(crcs, lens)) == [zlib.crc32(f.encode()) for f in fs]


def test_documents_equal_brute_force(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = sorted((tuple(r) for r in importance.resample(documents, bench).collect()), key=repr)
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [r.text for r in bench.collect()])
    assert got == want and sum(r[4] is not None for r in got) > 0


def test_messy_rows(spark, messy, messy_rows):
    """Nulls, repeated rows and ids, a 20,000-word text and clashing columns; ties of repeated rows take consecutive ranks."""
    bench = spark.createDataFrame([("one two three",), (None,), ("first line",)], "text string")
    got = sorted((tuple(r) for r in importance.resample(messy, bench).collect()), key=repr)
    want = brute([(r[0], r[1]) for r in messy_rows], ["one two three", None, "first line"])
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert sorted(r[4] for r in got if r[4]) == sorted(r[4] for r in want if r[4])


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "text string")
    assert importance.resample(empty, bench).count() == 0


def test_ranks_over_many_range_partitions(spark):
    """More rows than the range cut samples or one partition holds: each row comes out once, with its place."""
    n = 300_000
    scored = materialize(spark.range(n).repartition(12).selectExpr(
        "id doc_id", "if(id % 10 = 0, 5L, 30L) n_words", "xxhash64(id) n_features", "xxhash64(id, 1) weight", "cast(hash(id) % 50000 as bigint) score"), "scored")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = importance.rank_top(scored, scored.n_words >= 20, 5).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = [(r.doc_id, r.score) for r in scored.where("n_words >= 20").collect()]
    k = 5 * len(rows) // 100
    want = {doc: i + 1 for i, (doc, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0]))[:k])}
    assert len(got) == n and len({r.doc_id for r in got}) == n
    assert {r.doc_id: r.rank for r in got if r.rank is not None} == want
