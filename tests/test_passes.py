from pyspark.ml import Pipeline, Transformer
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import HashingTF, IDF, Tokenizer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from panelwright.models import zoo as Z
from panelwright.operators import splits as P


def test_the_hash_of_a_bootstrap_weight_is_made_once_a_row(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 7 != 0, F.col("id")).alias("k"))
    for key in ("id", "k"):
        u, w = P.uniform(key, seed="3.1"), P.bootstrap_weight([key], 1, 3)
        rows = df.select(u.alias("u"), w.alias("w")).collect()
        assert [r["w"] for r in rows] == [sum(r["u"] >= p for p in P.POISSON_ONE) for r in rows]
    assert df.select(w)._jdf.queryExecution().optimizedPlan().toString().split(" AS ")[0].count("md5(") == 1


class Counted(Transformer):
    calls = 0

    def _transform(self, df):
        Counted.calls += 1
        return df


def test_stages_without_a_fit_run_once_for_all_folds(spark):
    df = spark.range(40).select("id", (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 4 < 2).cast("int").alias("fold"),
                                F.when(F.col("id") % 2 == 0, "a b c").otherwise("c d").alias("text"))
    stages = [Tokenizer(inputCol="text", outputCol="t"), Counted(), HashingTF(inputCol="t", outputCol="tf", numFeatures=64), IDF(inputCol="tf", outputCol="features")]
    svc = LinearSVC(maxIter=3)
    got = Z.feature_grid_search(Pipeline(stages=stages), svc, ParamGridBuilder().addGrid(svc.regParam, [0.1]).build(), df, ["id"], "fold", 2, Z.f1_evaluator()).collect()
    assert Counted.calls == 1 and got[0]["metric"] == 1.0
