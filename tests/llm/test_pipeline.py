import corpus_pipeline
from conftest import SF

from panelwright.llm import line_dedup, mixing, packing, simhash, toxicity
from panelwright.sources.scratch import materialize


def test_stages_work_on_what_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "simhash near-dedup", "mixing", "packing"]
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(materialize(stage(spark, kept[-1], SF)))
        assert kept[-1].columns == docs.columns and kept[-1].count() > 0
    a, b, c, d, e = kept
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    called = toxicity.score_documents(a, labels).where("predicted = 1")
    assert b.count() == a.count() - called.count() and b.join(called, "doc_id").count() == 0
    lost = line_dedup.dedupe_lines(b).where("n_removed = n_lines and n_lines > 0").count()
    assert c.count() == b.count() - lost
    groups = {r["component_id"] for r in simhash.near_duplicates(c).collect()}
    assert sorted(r["doc_id"] for r in d.collect()) == sorted(groups)
    words = lambda df: df.select(mixing.word_count(df["text"]).alias("n")).groupBy().sum("n").first()[0]
    assert abs(words(e) - 1.5 * words(d)) <= d.select("source").distinct().count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, e, SF).toPandas()
    tokens = sum(len(packing.token_ids(r["text"] or "")) for r in e.collect())
    assert pieces["length"].sum() == tokens


def test_run_is_the_registered_query(spark):
    import __spark_entry__

    got = __spark_entry__.queries()["pipeline"](spark, SF)
    assert got.count() > 0 and "sequence_id" in got.columns


def test_stages_on_messy_and_empty_tables(spark, messy, empty):
    for docs in (messy, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, SF))
            assert docs.columns == messy.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()
