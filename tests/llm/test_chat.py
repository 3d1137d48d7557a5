from conftest import SF
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from panelwright.llm import chat


def test_held_out_conversations_are_recovered(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = chat.format_conversations(turns).where(chat.held_out(F.col("conv_id"))).agg(F.sum("right_turns")).first()[0]
    total = turns.where(chat.held_out(F.col("conv_id"))).count()
    assert total > 50 and got >= 0.75 * total


def test_marked_turns_give_their_texts_back(spark):
    turns = spark.createDataFrame([(c, t, ("user", "assistant")[t % 2], f"text {c} of turn {t}\nand more") for c in range(60) for t in range(4)], "conv_id long, turn long, role string, text string")
    raw = chat.raw_transcripts(turns)
    model = chat.fit(raw)
    right = 0
    for r in raw.collect():
        if all(b[0] != "\n" for b in r["blocks"]):
            got = model.parse(r["transcript"])
            want = [(("user", "assistant")[t % 2], f"text {r['conv_id']} of turn {t}\nand more") for t in range(4)]
            assert got == want and chat.render(got) == "".join(f"<|{a}|>\n{b}\n<|end|>\n" for a, b in want)
            right += 1
    assert right > 20


def test_viterbi_equals_the_best_of_all_paths(spark):
    model = chat.fit(chat.raw_transcripts(spark.read.parquet(f"{SF}/conversations.parquet")))
    lines = ["User: hello", "", "what now?", "AI: well", "x"]
    seen = [sum(t.get(v, o) for t, o, v in zip(model.emit, model.other, f)) for f in chat.line_features(lines)]
    score = lambda p: model.start[p[0]] + sum(seen[i][s] for i, s in enumerate(p)) + sum(model.step[a, b] for a, b in zip(p, p[1:]))
    best = max(product(range(len(model.start)), repeat=len(lines)), key=score)
    assert np.isclose(score(model.decode(lines)), score(best))


def test_messy_rows_and_empty_table(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, None, "tool", "y"), (None, 0, "user", "z"), (None, None, None, None), (2, 0, "user", ""), (3, 5, "user", "w " * 200000),
            (3, 5, "user", "w " * 200000), (4, 10**12, "assistant", "\n\n\n"), (5, 0, "user", "User: Assistant: both")]
    turns = spark.createDataFrame([(*r, "x", "x") for r in rows], "conv_id long, turn long, role string, text string, part string, way string")
    got = chat.format_conversations(turns).collect()
    assert {r["conv_id"] for r in got} == {1, 2, 3, 4, 5, None} and chat.format_conversations(turns.limit(0)).count() == 0


def test_long_conversations_are_parsed_in_segments(spark):
    turns = spark.range(3000).selectExpr("7L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('turn ', id) text")
    turns = turns.union(spark.range(5000).selectExpr("8L", "0L", "'user'", "concat('same place ', id)"))
    raw = chat.raw_transcripts(turns).select(F.size("roles").alias("n")).collect()
    assert sum(r["n"] for r in raw) == 8000 and max(r["n"] for r in raw) <= 4096


def test_flooded_segments_are_cut_in_order(spark):
    turns = spark.range(9000).selectExpr("1L conv_id", "0L turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('text ', lpad(id, 5, '0')) text")
    turns = turns.union(spark.range(10000).selectExpr("cast(null as long)", "3L", "'user'", "'the same'"))
    raw = chat.raw_transcripts(turns.repartition(7)).select("conv_id", "part.way", "roles", "blocks").collect()
    one = sorted((r for r in raw if r["conv_id"] == 1), key=lambda r: r["way"])
    got = [(role, block[-5:]) for r in one for role, block in zip(r["roles"], r["blocks"])]
    assert got == sorted((("user", "assistant")[i % 2], f"{i:05}") for i in range(9000)) and [len(r["roles"]) for r in one] == [4096, 4096, 808]
    # copies of one row are parted too
    assert sorted(len(r["roles"]) for r in raw if r["conv_id"] is None) == [1808, 4096, 4096]
