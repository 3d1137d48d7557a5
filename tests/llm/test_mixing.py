import re

import __spark_entry__
import oracle_check
import pytest
from conftest import SF

from panelwright.llm import mixing


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_equals_oracle(spark, sf):
    query, sql = __spark_entry__.queries()["op10_mixing"], __spark_entry__.oracle_sql()["op10_mixing"]
    assert oracle_check.compare(query(spark, sf), oracle_check.duck(sf), sql) is None


def test_messy_rows_keep_budgets(messy, messy_rows):
    got = messy.count(), mixing.mix(messy).toPandas()
    assert got[0] == len(got[1]) == len(messy_rows)
    sizes = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in messy_rows)
    assert sorted(got[1]["size"]) == sizes and (got[1]["taken"] <= 2 * got[1]["size"]).all()
    whole = mixing.plan_mix(messy, ["source"]).select("row.source", "size", "target", "taken").toPandas()
    by = whole.groupby("source", dropna=False).agg(target=("target", "first"), taken=("taken", "sum"), size=("size", "sum"))
    assert ((by["taken"] - by["target"]).abs() <= 0.5).all() and abs(by["target"].sum() - 1.5 * sum(sizes)) < 1e-6


def test_reruns_and_layouts_agree(messy):
    key = lambda df: sorted(map(str, mixing.mix(df).collect()))
    assert key(messy) == key(messy.repartition(5, "text"))


def test_mixed_documents_hold_the_taken_words(documents):
    want = mixing.mix(documents).groupBy().sum("taken").first()[0]
    mixed = mixing.mixed_documents(documents)
    assert mixed.columns == documents.columns
    assert mixed.select(mixing.word_count(mixed["text"]).alias("n")).groupBy().sum("n").first()[0] == want


def test_mixed_documents_of_messy_rows(messy):
    mixed = mixing.mixed_documents(messy)
    assert mixed.columns == messy.columns and mixed.where("text is null").count() == messy.where("text is null").count()


def test_empty_table(empty):
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_many_sources_are_ranked_by_code_point(spark):
    names = [f"s{i * 7919 % 1000}" for i in range(1000)] + ["é", "Z", "", "😀", "", None]
    got = mixing.source_rank(spark.createDataFrame([(n, 1) for n in names], "source string, source_size long")).collect()
    want = sorted((n for n in set(names) if n is not None), key=lambda s: s.encode()) + [None]
    assert [r["source"] for r in sorted(got, key=lambda r: r["rank"])] == want
