"""Chat formatting: roles of a raw transcript by a hidden Markov model, then canonical turns.

The states are the first and the later lines of each role's turns. A line shows
its speaker marker, whether it or the line before is blank, its length and how
it ends. All probabilities are counted over the training transcripts; Viterbi
decoding gives the roles, and each recovered turn is rendered in one form.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwright.sources.scratch import materialize

MARKER = re.compile(r"\s*(<\|[A-Za-z_ ]{1,20}\|>|#{1,4} ?[A-Za-z ]{1,20}?:?(?=\s*$)|\*{0,2}[A-Za-z ]{1,20}\*{0,2}:(?=\s|$))[ \t]*")
MARKERS = 500  # most speaker markers that the model tells apart; the rest count as one
ROLES = 12  # most roles that the model tells apart, the commonest
SEGMENT = 512  # turns parsed together; a longer conversation is parsed in segments
FLOOD = 4096  # most rows parsed together; a segment with more, by repeated turn numbers, is cut into consecutive blocks

#: How raw transcripts mark speakers, by style; the last two put the marker on a line of its own.
STYLES = (
    {"user": "User:", "assistant": "Assistant:", "system": "System:"},
    {"user": "Human:", "assistant": "AI:", "system": "Instructions:"},
    {"user": "Q:", "assistant": "A:", "system": "Note:"},
    {"user": "<|user|>", "assistant": "<|assistant|>", "system": "<|system|>"},
    {"user": "### Question", "assistant": "### Answer", "system": "### Context"},
)
UNMARKED = 8  # one turn in so many has no marker, only an empty line before it


def held_out(conv_id: Column) -> Column:
    """Whether a conversation takes no part in learning: crc32 of its id's text is divisible by 5; false for null."""
    return F.coalesce(F.crc32(conv_id.cast("string")) % 5 == 0, F.lit(False))


def raw_transcripts(turns: DataFrame) -> DataFrame:
    """(conv_id, part, roles, blocks, transcript) from a table of turns (conv_id, turn, role, text).

    ``blocks`` are the turns as they stand in the transcript, one conversation
    in one style. Conversations of more than ``SEGMENT`` turns give several
    parts, and parts of more than ``FLOOD`` rows several ways, which follow each
    other in the order of rows. Null texts are empty, null roles are
    ``unknown``, null turns come first, rows with equal turn numbers are ordered
    by role and text.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("turn") / SEGMENT), F.lit(-1)).cast("long"))
    # at most rows / FLOOD entries
    flood = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FLOOD)
    flood = F.broadcast(flood.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p")))
    own = rows["conv_id"].eqNullSafe(F.col("_c")) & (rows["part"] == F.col("_p"))
    rows = rows.join(flood, own, "left_anti").withColumn("way", F.lit(0).cast("long")).unionByName(_blocks(rows.join(flood, own).drop("_c", "_p")))
    style = F.pmod(F.xxhash64(F.lit(4), "conv_id"), F.lit(len(STYLES)))
    known = [x for k, names in enumerate(STYLES) for role, mark in names.items() for x in (F.lit(f"{k}{role}"), F.lit(mark + ("\n" if k > 2 else " ")))]
    mark = F.coalesce(F.element_at(F.create_map(*known), F.concat(style.cast("string"), F.col("role"))), F.concat(F.initcap("role"), F.lit(": ")))
    bare = F.pmod(F.xxhash64(F.lit(6), "conv_id", "turn"), F.lit(UNMARKED)) == 0
    block = F.concat(F.when(bare, F.lit("\n")).otherwise(mark), F.col("text"))
    listed = F.sort_array(F.collect_list(F.struct("turn", "role", block.alias("block"))))
    grouped = rows.groupBy("conv_id", "part", "way").agg(listed.alias("t"))
    return grouped.select("conv_id", F.struct("part", "way").alias("part"), F.col("t.role").alias("roles"), F.col("t.block").alias("blocks"),
                          F.array_join("t.block", "\n").alias("transcript"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Adds ``way``: rows of a segment, in order of turn, role and text, by consecutive blocks of ``FLOOD``.

    Ranges of that order are numbered by themselves and shifted by the rows of
    the ranges below. A number of its own parts equal rows, so no range has all of them.
    """
    order = ["turn", "role", "text", "nth"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the number is kept first, as the borders are drawn from one pass and used in another
    kept = materialize(rows.withColumn("nth", F.monotonically_increasing_id()), "flood")
    cut = materialize(kept.repartitionByRange(parts, "conv_id", "part", *order).withColumn("range", F.spark_partition_id()), "flood-ranges")
    below = F.sum("n").over(Window.partitionBy("conv_id", "part").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = cut.groupBy("conv_id", "part", "range").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("conv_id").alias("_c"), F.col("part").alias("_p"), F.col("range").alias("_r"), F.coalesce(below, F.lit(0)).alias("below"))
    placed = cut.withColumn("inside", F.row_number().over(Window.partitionBy("conv_id", "part", "range").orderBy(*order)))
    # a segment has at most ``parts`` ranges
    placed = placed.join(F.broadcast(offsets), placed["conv_id"].eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")) & (F.col("range") == F.col("_r")))
    return placed.select(*rows.columns, F.floor((F.col("below") + F.col("inside") - 1) / FLOOD).cast("long").alias("way"))


def line_features(lines: Sequence[str]) -> list[tuple[str, str, str, str]]:
    """What each line shows: marker, blank lines (itself, before, at the very start), length class, ending."""
    out, before = [], "start"
    for line in lines:
        found = MARKER.match(line)
        bare = line.strip()
        blank = "blank" if not bare else before
        out.append((re.sub(r"\s+", " ", found[1]).lower() if found else "", blank, str(min(6, len(bare).bit_length() // 2)), bare[-1:] if bare[-1:] in "?!.:" else "" if bare else "-"))
        before = "after-blank" if not bare else "in-text"
    return out


@dataclass
class Hmm:
    """Log probabilities; state ``2 r`` is the first line of a turn of role ``r``, ``2 r + 1`` a later one."""

    roles: list[str]
    start: np.ndarray
    step: np.ndarray
    emit: tuple[dict[str, np.ndarray], ...]
    other: tuple[np.ndarray, ...]

    def decode(self, lines: Sequence[str]) -> list[int]:
        """The likeliest state of every line."""
        seen = np.array([sum(table.get(v, none) for table, none, v in zip(self.emit, self.other, f)) for f in line_features(lines)])
        score, back = self.start + seen[0], []
        for row in seen[1:]:
            ways = score[:, None] + self.step
            back.append(ways.argmax(0))
            score = ways.max(0) + row
        path = [int(score.argmax())]
        for pointers in reversed(back):
            path.append(int(pointers[path[-1]]))
        return path[::-1]

    def parse(self, transcript: str) -> list[tuple[str, str]]:
        """(role, text) of the recovered turns, without markers and outer blank space; an empty transcript has none."""
        if not transcript.strip() or not self.roles:
            return []
        lines = transcript.split("\n")
        turns: list[tuple[str, list[str]]] = []
        for line, state in zip(lines, self.decode(lines)):
            if state % 2 == 0 or not turns:
                found = MARKER.match(line)
                turns.append((self.roles[state // 2], [line[found.end() :] if found and found[1].lower() in self.emit[0] else line]))
            else:
                turns[-1][1].append(line)
        return [(role, "\n".join(text).strip()) for role, text in turns]


def render(turns: Sequence[tuple[str, str]]) -> str:
    """Canonical form: role and text of each turn between fixed tags."""
    return "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns)


def fit(transcripts: DataFrame) -> Hmm:
    """Counts over all training transcripts; what reaches the driver is one row for each state and feature value, at most ``MARKERS`` markers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for roles, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                states = [s for role, block in zip(roles, blocks) for s in _states(role, block)]
                seen["start", "", states[0], ""] += 1
                seen.update(("step", a, b, "") for a, b in zip(states, states[1:]))
                lines = "\n".join(blocks).split("\n")
                seen.update((str(k), "", s, v) for s, f in zip(states, line_features(lines)) for k, v in enumerate(f))
            keys = list(seen)
            yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.string()) for i in range(4)), pa.array(list(seen.values()), pa.int64())], ["kind", "before", "state", "value", "n"])

    counts = transcripts.select("roles", "blocks").mapInArrow(count, "kind string, before string, state string, value string, n long").groupBy("kind", "before", "state", "value").agg(F.sum("n").alias("n"))
    marks = counts.where("kind = '0'").groupBy("value").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "value").limit(MARKERS).select("value")
    roles = [r["role"] for r in counts.where("kind = 'start' or kind = 'step'").groupBy(F.substring_index("state", "\t", 1).alias("role")).agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "role").limit(ROLES).collect()]
    kept = counts.where("kind != '0'").unionByName(counts.where("kind = '0'").join(F.broadcast(marks), "value")).where(F.substring_index("state", "\t", 1).isin(roles) if roles else F.lit(False))
    return _model(sorted(roles), [tuple(r) for r in kept.select("kind", "before", "state", "value", "n").collect()])


def _states(role: str, block: str) -> list[str]:
    """The state names of a block's lines; an empty line before an unmarked turn belongs to the turn before."""
    lines = block.split("\n")
    first = 1 if len(lines) > 1 and not lines[0] else 0
    return [f"{role}\t{'first' if k == first else 'later'}" for k in range(len(lines))]


def _model(roles: list[str], counts: list[tuple[str, str, str, str, int]]) -> Hmm:
    number = {f"{r}\t{kind}": 2 * k + j for k, r in enumerate(roles) for j, kind in enumerate(("first", "later"))}
    size = len(number)
    start, step = np.full(size, 0.1), np.full((size, size), 0.1)
    tables: list[dict[str, np.ndarray]] = [{} for _ in range(4)]
    for kind, before, state, value, n in counts:
        if state not in number or (before and before not in number):
            continue
        at = number[state]
        if kind == "start":
            start[at] += n
        elif kind == "step":
            step[number[before], at] += n
        else:
            tables[int(kind)].setdefault(value, np.full(size, 0.1))[at] += n
    emit, other = [], []
    for table in tables:
        total = sum(table.values(), np.full(size, 0.1))
        emit.append({v: np.log(n / total) for v, n in table.items()})
        other.append(np.log(0.1 / total))
    return Hmm(roles, np.log(start / max(start.sum(), 1e-9)), np.log(step / step.sum(1, keepdims=True)) if size else step, tuple(emit), tuple(other))


def format_conversations(turns: DataFrame) -> DataFrame:
    """Recovered and rendered conversations, one row for each conversation (or segment of a long one).

    conv_id, part, n_turns, roles (comma-joined), rendered, and right_turns: how
    many of the table's turns stand in the result with their role and place.
    The model learns from the conversations that are not held out. Nulls: see
    ``raw_transcripts``. A conversation without any text has no recovered turn.
    An empty table gives no rows; repeated rows are turns of their own; extra
    columns are ignored.
    """
    raw = raw_transcripts(turns.select("conv_id", "turn", "role", "text"))
    shared = turns.sparkSession.sparkContext.broadcast(fit(raw.where(~held_out(F.col("conv_id")))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for roles, transcript in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                got = shared.value.parse(transcript)
                out.append((len(got), ",".join(r for r, _ in got), render(got), sum(a == b for a, (b, _) in zip(roles, got)) if len(got) == len(roles) else 0))
            cols = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())],
                                             ["conv_id", "part", "n_turns", "roles", "rendered", "right_turns"])

    part = F.concat_ws("-", F.col("part.part").cast("string"), F.col("part.way").cast("string"))
    return raw.select("conv_id", part.alias("part"), "roles", "transcript").mapInArrow(
        run, "conv_id long, part string, n_turns long, roles string, rendered string, right_turns long")
