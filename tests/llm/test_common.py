from pyspark.sql import functions as F

from layerflow.llm.common import row_key, sample_of


def test_samples_are_bounded_and_stable(spark):
    df = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit("one hot text").alias("text"))
    a = sample_of(df, row_key(df), 1_000)
    n = a.count()
    assert 800 < n < 1_200                    # copies of a text are sampled one by one
    b = sample_of(df.repartition(7), row_key(df), 1_000)
    assert sorted(r.doc_id for r in a.collect()) == sorted(r.doc_id for r in b.collect())
    assert sample_of(df.limit(10), F.col("doc_id"), 1_000).count() == 10
    assert 0 < sample_of(df, F.col("doc_id"), 3).count() < 15
