"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage
before kept, and returns the columns of documents, except the last, which
returns the packed pieces. ``run`` writes each stage to the shared folder and
reads it again, so a lost executor costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelwright.llm import line_dedup, mixing, packing, simhash, toxicity
from panelwright.sources.scratch import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats and near repeats of lines go, and documents of which nothing is left."""
    return line_dedup.without_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight; documents of small, heavy sources come up to twice."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained classifier and a tokenizer have no SQL form; the tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
