"""Ensembles as SQL against Spark's own scoring."""

import random

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from layerflow.llm.trees import boosted_sql, forest_sql


def test_sql_equals_the_models(spark):
    rng = random.Random(5)
    rows = [(a := rng.random(), b := float(rng.randint(0, 3)), c := rng.gauss(0, 1), float(a + 0.2 * b + 0.3 * c + rng.gauss(0, 0.3) > 0.8))
            for _ in range(400)]
    names = ["a", "b", "c"]
    df = VectorAssembler(inputCols=names, outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, c double, label double")).coalesce(1)
    for learner, sql in ((RandomForestClassifier(numTrees=7, maxDepth=5, seed=3), forest_sql),
                         (GBTClassifier(maxIter=6, maxDepth=3, seed=3), boosted_sql)):
        model = learner.fit(df)
        scored = model.transform(df).select(F.expr(sql(model, names)).alias("own"), vector_to_array("probability")[1].alias("theirs"))
        got = [(r.own, r.theirs) for r in scored.collect()]
        assert all(abs(x - y) < 1e-12 for x, y in got) and len({round(x, 6) for x, _ in got}) > 5
