import numpy as np
import pytest
from conftest import SF, words

from panelwright.llm import toxicity

INSULTS = ["vileword", "nastyword", "foulword"]


def corpus(spark, n=700):
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        text = words(40, i).split()
        if toxic:
            text.insert(i % 40, INSULTS[i % 3].upper() if i % 2 else INSULTS[i % 3])
        rows.append((i, " ".join(text), ("en", "fr")[i % 2], int(toxic)))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    got = toxicity.score_documents(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got["held_out"]]
    assert len(got) == 700 and 150 < len(held) < 320
    assert (held["predicted"] == held["toxic"]).mean() >= 0.97
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.7) == (got["predicted"] == 1)).all()


def test_held_out_follows_crc32(spark):
    import zlib

    docs, labels = corpus(spark, 50)
    got = toxicity.score_documents(docs, labels).toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got["doc_id"], got["held_out"]))


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = corpus(spark, 300)
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(labels["doc_id"]), 1 - labels["toxic"]).otherwise(labels["toxic"]))
    a, b = (toxicity.score_documents(docs, x).toPandas().sort_values("doc_id")["score"].to_numpy() for x in (labels, flipped))
    assert (a == b).all()


def test_messy_rows_and_empty_tables(spark, messy, messy_rows, empty):
    _, labels = corpus(spark, 60)
    got = toxicity.score_documents(messy, labels).toPandas()
    assert len(got) == len(messy_rows) and got["score"].between(0, 1).all()
    assert toxicity.score_documents(empty, labels).count() == 0
    nothing = toxicity.score_documents(messy, labels.limit(0)).toPandas()
    assert len(nothing) == len(messy_rows) and (nothing["predicted"] == 0).all()
    kept = toxicity.keep_clean(messy, labels)
    assert kept.columns == messy.columns and kept.count() == (got["predicted"] == 0).sum()


def test_pooling_equals_plain_convolution():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (0, 1, 2, 5, 40)]
    model = toxicity.train(texts * 4, np.array([0, 1] * 10, np.float32), ["en"] * 20, epochs=1)
    hashes, rows = np.concatenate(texts), np.r_[0, np.cumsum([len(t) for t in texts])]
    got = model.pooled(*toxicity._rows_of(hashes), rows)
    for i, t in enumerate(texts):
        a, b = toxicity._rows_of(t)
        x = np.concatenate([np.zeros((2, 16)), np.concatenate([model.tables[0][a], model.tables[1][b]], 1), np.zeros((2, 16))]).astype(np.float32)
        want = np.concatenate([np.max([sum(x[p + k] @ model.filters[w][k] for k in range(w)) for p in range(len(t) + 2)], 0) + model.biases[w] for w in toxicity.WIDTHS])
        assert got[i] == pytest.approx(want, abs=1e-4)


def test_thresholds_count_all_labelled_rows(spark, monkeypatch):
    docs, labels = corpus(spark)
    docs = docs.union(spark.createDataFrame([(i, words(9000, i) + " vileword" * (i % 2), "en") for i in range(1000, 1008)], docs.schema))
    labels = labels.union(spark.createDataFrame([(i, i % 2) for i in range(1000, 1008)], labels.schema))
    seen = []
    monkeypatch.setattr(toxicity, "_calibrate", lambda model, counts: seen.append(counts))
    toxicity.fit(docs, labels, 80)
    want = labels.where(~toxicity.held_out(labels["doc_id"]))
    long = want.where("doc_id >= 1000").count()
    assert seen[0]["n"].sum() == want.count() and seen[0].loc[seen[0]["toxic"] == 1, "n"].sum() == want.where("toxic = 1").count()
    assert long and seen[0].loc[seen[0]["long"], "n"].sum() == long and seen[0].loc[seen[0]["seen"], "n"].sum() in range(50, 61)


def test_a_small_language_has_its_own_threshold():
    import pandas as pd

    def rows(language, toxic, at, n, seen=False):
        return {"language": language, "toxic": toxic, "step": int(at * toxicity.STEP), "long": False, "seen": seen, "n": n}

    model = toxicity.train([np.array([i], np.uint64) for i in range(40)], np.array([0, 1] * 20, np.float32), ["en", "fr"] * 20, epochs=1)
    # scores of learned rows must not draw the threshold up
    counts = [rows(0, 1, 2, 90000), rows(0, 0, -2, 900000), rows(1, 1, 6, 2000), rows(1, 0, 4, 20000), rows(1, 1, 9, 900, True), rows(0, 0, -9, 2000, True)]
    toxicity._calibrate(model, pd.DataFrame(counts))
    assert abs(model.cuts[0]) < 0.1 and 4.5 < model.cuts[1] < 5.2


def test_registered_query(spark):
    import __spark_entry__

    got = __spark_entry__.queries()["op5_toxicity"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
