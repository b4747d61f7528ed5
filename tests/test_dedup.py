import datetime as dt

from pyspark.sql import functions as F

from layerflow.operators.dedup import dedup_latest

ROWS = [("k1", dt.datetime(2024, 1, 1), "old", 1), ("k1", dt.datetime(2024, 1, 2), "new", 2),
        ("k2", dt.datetime(2024, 1, 1), "b", 5), ("k2", dt.datetime(2024, 1, 1), "a", 9),
        (None, dt.datetime(2024, 1, 1), "n1", 1), (None, dt.datetime(2024, 1, 3), "n2", 1)]
SCHEMA = "k string, ts timestamp, v string, x int"


def _latest(df):
    return list(tuple(r) for r in dedup_latest(df, ["k"], ["ts"]).select("k", "v").collect())


def test_later_row_kept_ties_broken_by_other_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert sorted(_latest(df), key=str) == sorted([("k1", "new"), ("k2", "a"), (None, "n2")], key=str)


def test_result_independent_of_partitioning(spark):
    df = spark.createDataFrame(ROWS * 3, SCHEMA)
    base = sorted(map(str, _latest(df)))
    for n in (1, 2, 7):
        assert sorted(map(str, _latest(df.repartition(n)))) == base
        assert sorted(map(str, _latest(df.orderBy(F.rand(n)).coalesce(1)))) == base


def test_plan_limits_before_shuffle(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = dedup_latest(ev, ["user_id"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("WindowGroupLimit")
    assert "Partial" in plan and "Final" in plan
    # the partial limit sits below (after, in the text) the exchange
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert partial >= 0


def test_hot_null_key_keeps_one_row(spark):
    df = spark.range(0, 5000).select(F.lit(None).cast("string").alias("k"),
                                     F.col("id").alias("x"),
                                     F.lit(dt.datetime(2024, 1, 1)).alias("ts"))
    out = dedup_latest(df, ["k"], ["ts"]).collect()
    assert len(out) == 1 and out[0].x == 0
