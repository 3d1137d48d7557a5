"""License scans with a generalised suffix automaton over licence words.

All templates are fed into one automaton. Each document streams through it word
by word; the automaton keeps the longest run of words that ends here and occurs
in some template (matching statistics). Runs that cannot be extended and are
long enough are chained in template order into spans, and a template whose
words are covered by a chain gives its label.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelwright.llm.bytescan import ALNUM, hashed_words, slices, word_hash

#: Phrases that are found at every place, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Wording of public licence notices, by label.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "mit": "released under the mit license",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "gpl-3.0": "licensed under the gnu general public license version 3",
    "gpl-2.0": "licensed under the gnu general public license version 2",
    "lgpl": "gnu lesser general public license",
    "agpl": "gnu affero general public license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "epl-2.0": "made available under the terms of the eclipse public license 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc-by-4.0": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc0-1.0": "waived all copyright and related or neighboring rights to this work",
    "boost": "distributed under the boost software license version 1 0",
    "zlib": "this software is provided as is without any express or implied warranty in no event will the authors be held liable",
}
LEAST = 2  # words of a run that counts
GAP = 12  # words that may stand between two runs of a chain
COVERED = 0.8  # share of a template's words that a chain has to cover for its label


@dataclass
class _State:
    length: int
    link: int = -1
    steps: dict[int, int] = field(default_factory=dict)


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the end positions of every state."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.states = [_State(0)]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for number, words in enumerate(sequences):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, word)
                self.ends[last].append((number, at + 1))
        for s in sorted(range(1, len(self.states)), key=lambda i: -self.states[i].length):
            link = self.states[s].link
            if link > 0:
                self.ends[link] = sorted(set(self.ends[link]) | set(self.ends[s]))

    def _new(self, length: int, link: int, steps: Mapping[int, int]) -> int:
        self.states.append(_State(length, link, dict(steps)))
        self.ends.append([])
        return len(self.states) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._new(self.states[p].length + 1, self.states[q].link, self.states[q].steps)
        self.states[q].link = clone
        while p >= 0 and self.states[p].steps.get(word) == q:
            self.states[p].steps[word] = clone
            p = self.states[p].link
        return clone

    def _extend(self, last: int, word: int) -> int:
        q = self.states[last].steps.get(word)
        if q is not None:
            return q if self.states[q].length == self.states[last].length + 1 else self._split(last, word, q)
        new, p = self._new(self.states[last].length + 1, 0, {}), last
        while p >= 0 and word not in self.states[p].steps:
            self.states[p].steps[word] = new
            p = self.states[p].link
        if p >= 0:
            q = self.states[p].steps[word]
            self.states[new].link = q if self.states[q].length == self.states[p].length + 1 else self._split(p, word, q)
        return new

    def matches(self, words: Sequence[int]) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of every run that the next word does not extend; words below zero occur nowhere."""
        state = length = 0
        for at, word in enumerate(words):
            step = self.states[state].steps.get(word)
            if step is None:
                if length:
                    yield at, length, state
                while state and step is None:
                    state = self.states[state].link
                    length = self.states[state].length
                    step = self.states[state].steps.get(word)
                if step is None:
                    length = 0
                    continue
            state, length = step, length + 1
        if length:
            yield len(words), length, state


@dataclass
class Scan:
    """What one document holds: base places, and chained spans (label, first word, end word, covered share)."""

    n_words: int
    starts: list[int]
    base_labels: list[str]
    spans: list[tuple[str, int, int, float]]

    @property
    def labels(self) -> list[str]:
        return sorted({*self.base_labels, *(s[0] for s in self.spans if s[3] >= COVERED)})

    @property
    def score(self) -> float:
        return max((s[3] for s in self.spans), default=0.0)


class LicenseScanner:
    def __init__(self, base: Mapping[str, str] = BASE, templates: Mapping[str, str] = TEMPLATES):
        texts = [(label, phrase.split()) for phrase, label in base.items()] + [(label, text.split()) for label, text in templates.items()]
        names = sorted({w for _, words in texts for w in words})
        hashes = np.array([word_hash(w) for w in names], np.uint64)
        order = np.argsort(hashes)
        self._hashes, rank = hashes[order], {names[k]: i for i, k in enumerate(order)}
        coded = [[rank[w] for w in words] for _, words in texts]
        self.labels, self.sizes = [label for label, _ in texts], [len(c) for c in coded]
        self.base = [(np.array(c), label) for c, (label, _) in zip(coded[: len(base)], texts)]
        self.automaton = SuffixAutomaton(coded)

    def codes(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Licence word numbers (-1 for other words) of a slice and the first word of each row."""
        hashes, rows = hashed_words(column, ALNUM)
        at = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        return np.where(self._hashes[at] == hashes, at, -1), rows

    def scan(self, column: pa.Array) -> list[Scan]:
        codes, rows = self.codes(column)
        owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        starts: dict[int, list[int]] = defaultdict(list)
        named: dict[int, set[str]] = defaultdict(set)
        for phrase, label in self.base:
            n = len(codes) - len(phrase) + 1
            if n <= 0:
                continue
            hit = owner[:n] == owner[len(phrase) - 1 :]
            for k, word in enumerate(phrase):
                hit &= codes[k : k + n] == word
            for at in np.flatnonzero(hit).tolist():
                row = int(owner[at])
                starts[row].append(at - int(rows[row]))
                named[row].add(label)
        # only stretches of two or more licence words can hold a run that counts
        known = codes >= 0
        near = np.zeros(len(codes) + 1, bool)
        near[1:-1] = known[1:] & known[:-1] & (owner[1:] == owner[:-1]) if len(codes) else False
        keep = near[:-1] | near[1:]
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        edges = np.flatnonzero(np.diff(np.r_[False, keep, False].astype(np.int8)))
        listed = codes.tolist()
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            for cut in np.split(np.arange(a, b), np.flatnonzero(np.diff(owner[a:b])) + 1):
                lo, hi = int(cut[0]), int(cut[-1]) + 1
                row = int(owner[lo])
                for end, length, state in self.automaton.matches(listed[lo:hi]):
                    if length >= LEAST:
                        found[row].append((lo + end - int(rows[row]), length, state))
        return [Scan(int(rows[r + 1] - rows[r]), starts.get(r, []), sorted(named.get(r, ())), self._chains(found.get(r, []))) for r in range(len(rows) - 1)]

    def _chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Runs in text order joined per template while they advance in it and stand within ``GAP`` words; a chain that falls back closes."""
        open_: dict[int, list[int]] = {}  # template: first word, end word, template end, covered words
        best: list[tuple[str, int, int, float]] = []

        def close(template: int) -> None:
            first, end, _, covered = open_.pop(template)
            best.append((self.labels[template], first, end, min(1.0, covered / self.sizes[template])))

        for end, length, state in matches:
            for template, tail in self.automaton.ends[state]:
                if template in open_:
                    chain = open_[template]
                    fresh = min(length, tail - chain[2])
                    if fresh > 0 and end - fresh >= chain[1] and end - length - chain[1] <= GAP:
                        chain[1], chain[2], chain[3] = end, tail, chain[3] + fresh
                        continue
                    if end - length < chain[1]:
                        continue  # another place of the same run in this template
                    close(template)
                open_[template] = [end - length, end, tail, length]
        for template in list(open_):
            close(template)
        return best


def scan_documents(docs: DataFrame, base: Mapping[str, str] = BASE, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """License findings of every whole text.

    doc_id, n_words, n_base (all places), first_word, last_word (smallest and
    largest start, null without any), base_labels, labels (base ones and those
    of the chained templates), score (largest covered share) and spans (label,
    first word, end word, covered share). Null and empty texts have no words,
    empty labels and score 0. An empty table gives no rows; repeated rows are
    scanned alike; extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(LicenseScanner(base, templates))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("covered", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                got = shared.value.scan(batch.column(1).slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array([s.n_words for s in got], pa.int64()), pa.array([len(s.starts) for s in got], pa.int64()),
                    pa.array([min(s.starts, default=None) for s in got], pa.int64()), pa.array([max(s.starts, default=None) for s in got], pa.int64()),
                    pa.array([",".join(s.base_labels) for s in got], pa.string()), pa.array([",".join(s.labels) for s in got], pa.string()),
                    pa.array([s.score for s in got], pa.float64()),
                    pa.array([[dict(zip(("label", "first_word", "end_word", "covered"), x)) for x in s.spans if x[3] >= COVERED] for s in got], pa.list_(span)),
                ], names)

    schema = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
              "spans array<struct<label:string,first_word:long,end_word:long,covered:double>>")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
