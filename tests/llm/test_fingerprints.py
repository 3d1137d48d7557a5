import hashlib
import random

import pytest

from panelwright.llm import fingerprints as fp


def compare(docs):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    got = fp.fingerprint_documents(docs).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r in got:
        assert r["near_edited"] == pytest.approx(fp.likeness(r["fingerprint"], r["edited_fingerprint"]))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    ids = [i for i, _ in rows]
    if len(set(ids)) == len(ids) and None not in ids:
        order = sorted(rows, reverse=True)
        for k, (i, text) in enumerate(order):
            follow = order[(k + 1) % len(order)][1]
            half = len(text) // 2
            edited = text[: len(text) - half] + follow[:half]
            r = next(r for r in got if r["doc_id"] == i)
            assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert r["fingerprint"] == fp.fingerprint(fp.PrefixHash(text)) and r["edited_fingerprint"] == fp.fingerprint(fp.PrefixHash(edited))
            assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
            plain = next((j for j, (a, b) in enumerate(zip(text, edited)) if a != b), min(len(text), len(edited)))
            assert r["common_prefix"] == plain


def test_equals_plain_python(documents):
    compare(documents)


def test_messy_rows(messy):
    compare(messy)
    compare(messy.where("doc_id is not null").dropDuplicates(["doc_id"]))


def test_few_rows(spark, empty):
    assert fp.fingerprint_documents(empty).count() == 0
    for n in (1, 2, 3):
        compare(spark.createDataFrame([(i * 10, "text of row %d " % i * (i + 1)) for i in range(n)], "doc_id long, text string"))


def test_spans_and_extensions():
    rng = random.Random(5)
    a = "".join(rng.choice("abé😀") for _ in range(400))
    b = a[37:300] + "x" + a[300:]
    x, y = fp.PrefixHash(a), fp.PrefixHash(b)
    for _ in range(300):
        i, j, n = rng.randrange(300), rng.randrange(300), rng.randrange(60)
        assert x.equal(i, y, j, n) == (a[i : i + n] == b[j : j + n])
        assert (x.span(i, n) == y.span(j, n)) == (a[i : i + n] == b[j : j + n])
        k = 0
        while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
            k += 1
        assert x.extension(i, y, j) == k


def test_likeness_follows_overlap():
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(8000))
    marks = [fp.fingerprint(fp.PrefixHash(text[:n] + "".join(rng.choice("qrstuvwxyz") for _ in range(8000 - n)))) for n in (8000, 7200, 4000, 0)]
    near = [fp.likeness(marks[0], m) for m in marks]
    assert near[0] == 1 and near[0] > near[1] > near[2] > near[3] and near[1] > 0.6 and near[3] < 0.1
