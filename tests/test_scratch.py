import os

import pytest

from panelwright.operators.reshape import spearman_matrix
from panelwright.sources import scratch


def entries(spark):
    root = scratch.scratch_root(spark).removeprefix("file:")
    return {e for e in os.listdir(root) if "-" in e} if os.path.isdir(root) else set()


def test_scratch_is_empty_after_a_run(spark):
    import __spark_entry__

    before = entries(spark)
    with scratch.scratch_area(spark):
        rows = __spark_entry__.queries()["j16_passenger_raw_view"](spark, "/root/testdata/sf0.001").collect()
        assert entries(spark) - before
        with scratch.scratch_area(spark):
            scratch.materialize(spark.range(3)).count()
    assert rows and entries(spark) == before


def test_a_failing_run_cleans_up_too(spark):
    before = entries(spark)
    with pytest.raises(ZeroDivisionError), scratch.scratch_area(spark):
        scratch.materialize(spark.range(3))
        1 / 0
    assert entries(spark) == before


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session())


def test_exchanges_of_the_rank_matrix_do_not_grow_with_the_columns(spark):
    df = spark.range(50).selectExpr("id", "id % 7 a", "id % 5 b", "id % 3 c", "id % 11 d", "id % 13 e")
    count = lambda cols: spearman_matrix(df, cols, ["id"])._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert count(["a", "b"]) == count(["a", "b", "c", "d", "e"])
