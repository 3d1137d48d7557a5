import zlib

from conftest import SF

from panelwright.llm import langid


def test_held_out_accuracy_of_the_query(spark, documents):
    import __spark_entry__

    got = __spark_entry__.queries()["op7_language_id"](spark, SF).join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got["doc_id"], got["held_out"]))
    held = got[got["held_out"]]
    assert len(held) > 20 and (held["lang"] == held["lang_pred"]).mean() >= 0.95 and got["score"].between(0, 1).all()


def test_texts_without_letters_are_und(messy, messy_rows):
    got = langid.identify(messy).toPandas()
    assert len(got) == len(messy_rows)
    by_id = {i: p for i, p in zip(got["doc_id"], got["lang_pred"])}
    assert {by_id[i] for i in (5, 6, 7, 16)} == {"und"} and {by_id[i] for i in (8, 9, 12)} <= {"en", "fr", "de", "es"}
    assert (got.loc[got["lang_pred"] == "und", "rejected"]).all()


def test_nothing_to_learn_and_empty_table(spark, messy, messy_rows, empty):
    from pyspark.sql import functions as F

    assert langid.identify(empty).count() == 0
    got = langid.identify(messy.withColumn("lang", F.lit(None).cast("string"))).toPandas()
    assert len(got) == len(messy_rows) and (got["lang_pred"] == "und").all()


def test_batch_layout_does_not_change_a_text():
    import numpy as np
    import pyarrow as pa

    model = langid.LanguageModel(["a", "b"], np.random.default_rng(0).normal(size=(langid.BUCKETS, 2)), np.zeros(2), 1.0, 0.0)
    texts = ["Hello world", "", "éà ü", "x", "123", "ab" * 500]
    alone = [model.probabilities(pa.array([t]))[0] for t in texts]
    assert np.allclose(model.probabilities(pa.array(texts)), alone)
