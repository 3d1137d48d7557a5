import hashlib
import re

import pytest
from conftest import SF

from panelwright.llm import fim

SENT = ("<P>", "<S>", "<M>")


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    hx = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hx[8 * k:8 * k + 8], 16) for k in range(4)]
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if n == 0 or any(s in text for s in SENT) or h[2] % 100 >= 100:
        form, out, restored = "plain", text, text
    else:
        form = "spm" if h[3] % 100 < 50 else "psm"
        out = "<S>" + suf + "<P>" + pre + "<M>" + mid if form == "spm" else "<P>" + pre + "<S>" + suf + "<M>" + mid
        # rebuild from the output alone
        if form == "psm":
            p, rest = out[3:].split("<S>", 1)
            s, m = rest.split("<M>", 1)
        else:
            s, rest = out[3:].split("<P>", 1)
            p, m = rest.split("<M>", 1)
        restored = p + m + s
    plain = form == "plain"
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, n, form, None if plain else len(pre), None if plain else len(mid), sha(out), sha(restored))


def check(df, rows):
    got = sorted((tuple(r) for r in fim.fim_digests(df).collect()), key=repr)
    want = sorted((brute(d, t) for d, t in rows), key=repr)
    assert got == want
    assert all(brute(d, t)[6] == hashlib.sha256((t or "").encode()).hexdigest() for d, t in rows)


def test_documents_equal_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    check(documents, rows)
    forms = {brute(d, t)[2] for d, t in rows}
    assert forms >= {"psm", "spm"}


def test_messy_rows(spark, messy, messy_rows):
    check(messy, [(r[0], r[1]) for r in messy_rows])


def test_sentinels_lines_and_empty(spark):
    rows = [(1, "a\nb\n"), (2, "x <P> y\nz"), (3, ""), (4, None), (5, "\n\n\n"), (6, "no break at all " * 500), (7, "a\n" * 5000), (7, "a\n" * 5000)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_empty_table(empty):
    assert fim.fim_digests(empty).count() == 0


def test_pieces_assemble_the_output(spark):
    rows = [(i, "\n".join(f"line {i} {j}" for j in range(i % 7)) + ("\n" if i % 2 else "")) for i in range(40)]
    pieces = fim.fim_pieces(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {}
    for p in sorted(pieces, key=lambda p: (p.key, p.slot, p.idx)):
        by.setdefault(p.key, [None, []])
        if p.slot == -1:
            by[p.key][0] = p.doc_id
        else:
            by[p.key][1].append(p.text)
    outs = {d: hashlib.sha256("".join(t).encode()).hexdigest() for d, t in by.values()}
    assert outs == {d: brute(d, t)[5] for d, t in rows}
