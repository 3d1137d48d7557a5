import re

import numpy as np
import xxhash

from panelwright.llm import simhash
from panelwright.llm.components import connected_components


def plain(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i : i + 3]).encode(), 42) for i in range(max(1, len(found) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(pairs):
    """(doc_id, bits) -> smallest linked doc_id of every row, null ids last."""
    bits = np.array([b for _, b in pairs], np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None]) <= 2
    label = np.arange(len(pairs))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    out = []
    for i in range(len(pairs)):
        ids = [pairs[j][0] for j in np.flatnonzero(label == label[i]) if pairs[j][0] is not None]
        out.append(min(ids) if ids else None)
    return out


def compare(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    pairs = [(i, plain(t)) for i, t in rows]
    want = sorted(((i, f"{b:016x}", c) for (i, b), c in zip(pairs, brute(pairs))), key=str)
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    assert got == want


def test_equals_brute_force(documents):
    compare(documents)


def test_messy_rows(messy):
    compare(messy)


def test_empty_table(empty):
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


def test_every_pair_within_two_bits_shares_an_anchor():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 200, dtype=np.uint64)
    for flips in (0, 1, 2):
        b = a.copy()
        for i in range(len(b)):
            for bit in rng.choice(46, flips, replace=False):
                b[i] ^= np.uint64(1 << int(bit))
        ra, aa = simhash.anchors(a)
        rb, ab = simhash.anchors(b)
        for i in range(len(a)):
            assert np.intersect1d(aa[ra == i], ab[rb == i]).size


def test_large_clusters_are_spanned_by_few_links(spark):
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 2**62))
    near = sorted({centre ^ (1 << int(i)) ^ (1 << int(j)) for i in range(40) for j in range(i)})
    far = [int(x) for x in rng.integers(0, 2**62, 200)]
    prints = spark.createDataFrame([(x,) for x in near + far], "bits long")
    edges = simhash.anchor_links(prints)
    parts = {r["component"] for r in connected_components(edges).where(f"node in ({','.join(map(str, near))})").collect()}
    assert len(parts) == 1 and edges.count() < 40 * len(near)


def test_keep_first_leaves_one_of_each_group(spark, messy, messy_rows):
    kept = simhash.keep_first(messy)
    assert kept.columns == messy.columns
    rows = spark.createDataFrame([(i, r[1]) for i, r in enumerate(messy_rows)], "doc_id long, text string")
    groups = {r["component_id"] for r in simhash.near_duplicates(rows).collect()}
    assert kept.count() == len(groups)


def test_keep_first_keeps_groups_that_share_an_id(spark):
    a, b = " ".join(f"alpha{i}" for i in range(40)), " ".join(f"beta{i}" for i in range(40))
    docs = spark.createDataFrame([(1, a), (1, b), (2, b), (3, a)], "doc_id long, text string").repartition(2)
    assert sorted(tuple(r) for r in simhash.keep_first(docs).collect()) == [(1, a), (1, b)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[1000 + i] for i in range(300)} == {1000} and len(got) == 361
