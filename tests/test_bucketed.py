import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.operators import tables as tb
from layerflow.operators.publish import publish
from layerflow.operators.update import update_table

CUST = "/root/testdata/sf0.001/customer.parquet"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _tables(spark, ws, buckets):
    c = spark.read.parquet(CUST)
    target, source = c.filter("c_acctbal < 5000"), c.filter("c_acctbal >= 2500").withColumn(
        "c_name", F.concat("c_name", F.lit("*")))
    name = ws.name(f"cust_b{buckets}")
    publish(spark, target, name, "MERGE", "c_custkey", root=ws.table_root(name), buckets=buckets)
    return name, source


def test_bucketed_merge_matches_plain_merge(spark, ws):
    plain, source = _tables(spark, ws, 0)
    bucketed, _ = _tables(spark, ws, 4)
    assert tb.bucket_spec(spark, bucketed) == (["c_custkey"], 4)
    assert tb.not_null_columns(spark, bucketed) == ["c_custkey"]
    r1 = publish(spark, source, plain, "MERGE", "c_custkey")
    r2 = publish(spark, source, bucketed, "MERGE", "c_custkey")
    assert r1.counts() == r2.counts()
    assert _rows(spark.table(plain)) == _rows(spark.table(bucketed))
    # still bucketed: a join of two such tables needs no exchange
    assert tb.bucket_spec(spark, bucketed) == (["c_custkey"], 4)
    assert update_table(spark, bucketed, {"c_name": F.lit("u")}, F.col("c_acctbal") > 9000) > 0
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = spark.table(bucketed)
        plan = t.join(t.selectExpr("c_custkey AS k"), F.col("c_custkey") == F.col("k"))
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
        assert plan.count() == t.count() == spark.table(plain).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucket_key_must_be_not_null(spark, ws):
    schema = T.StructType([T.StructField("k", T.StringType(), True)])
    with pytest.raises(ValueError, match="NOT NULL"):
        tb.create_table(spark, ws.name("bad"), schema, ws.table_root("bad"),
                        bucket_by=["k"], buckets=4)


def test_a_new_table_is_scanned_by_buckets(spark, ws):
    """No file of a new bucketed table is outside the buckets: a merge or join of large inputs reads it by them."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        name, empty = ws.name("fresh"), ws.name("fresh_empty")
        rows = spark.range(100).selectExpr("id AS k", "'a' AS v")
        publish(spark, rows, name, "MERGE", "k", root=ws.table_root("fresh"), buckets=4)
        res = publish(spark, spark.range(50, 150).selectExpr("id AS k", "'b' AS v"), name, "MERGE", "k")
        assert (res.records_updated, res.records_inserted) == (50, 50)
        got = {r.k: r.v for r in spark.table(name).collect()}
        assert got == {k: "a" if k < 50 else "b" for k in range(150)}
        tb.create_table(spark, empty, T.StructType([T.StructField("v", T.StringType()), T.StructField("k", T.LongType(), False)]),
                        ws.table_root("fresh_empty"), bucket_by=["k"], buckets=4)
        both = spark.table(name).join(spark.table(empty).select("k"), "k", "left_semi")
        assert both.count() == 0 and "Bucketed: true" in both._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
