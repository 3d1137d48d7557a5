import re

from panelwright.llm import licenses


def compare(docs):
    got = {r["doc_id"]: r for r in licenses.scan_documents(docs).collect()}
    for row in docs.collect():
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row["text"] or "")
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        starts, labels = [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            at = [i for i in range(len(found) - len(p) + 1) if found[i : i + len(p)] == p]
            starts += at
            labels |= {label} if at else set()
        r = got[row["doc_id"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(found), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        if starts:
            assert r["score"] == 1


def test_base_places_equal_plain_search(documents):
    compare(documents)


def test_messy_rows(messy):
    compare(messy.where("doc_id is not null").dropDuplicates(["doc_id"]))
    assert licenses.scan_documents(messy).count() == messy.count()


def test_empty_table(empty):
    assert licenses.scan_documents(empty).count() == 0


def test_planted_phrases(spark):
    texts = ["CC BY-NC 4.0 cc by cc by", "Licensed under the Apache License, Version 2.0.", "the GNU general public license general public license", "all rights\nreserved. All Rights Reserved",
             "Permission is hereby granted, free of charge, to any person who is obtaining a copy of this software and associated documentation files", "cc x by general public", "cc", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    compare(docs)
    got = {r["doc_id"]: r for r in licenses.scan_documents(docs).collect()}
    assert got[0]["n_base"] == 3 and "apache-2.0" in got[1]["labels"].split(",") and got[2]["n_base"] == 2 and got[3]["n_base"] == 2
    assert "mit-notice" in got[4]["labels"].split(",") and got[5]["n_base"] == 0 and got[7]["score"] == 0
    assert got[4]["spans"][0]["first_word"] == 0 and got[4]["spans"][0]["end_word"] == got[4]["n_words"]


def test_matching_statistics_equal_plain_search():
    import random

    rng = random.Random(2)
    templates = [[rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(6)]
    automaton = licenses.SuffixAutomaton(templates)
    for _ in range(200):
        text = [rng.randrange(-1, 5) for _ in range(30)]
        inside = lambda run: any(run == t[i : i + len(run)] for t in templates for i in range(len(t) - len(run) + 1))
        longest = []
        for end in range(1, len(text) + 1):
            longest.append(max((n for n in range(1, end + 1) if inside(text[end - n : end])), default=0))
        want = [(end, n) for end, n in enumerate(longest, 1) if n and (end == len(text) or longest[end] != n + 1)]
        got = list(automaton.matches(text))
        assert [(e, n) for e, n, _ in got] == want
        for end, n, state in got:
            run = text[end - n : end]
            assert automaton.ends[state] == sorted((k, i + n) for k, t in enumerate(templates) for i in range(len(t) - n + 1) if t[i : i + n] == run)
