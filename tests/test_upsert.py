import pytest
from pyspark.sql import functions as F

from layerflow.operators.publish import MergeCardinalityError, publish
from layerflow.operators.upsert import merged, source_profile

SCHEMA = "id bigint, name string, amount double"
TARGET = [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (None, "t-null", 0.0)]
SOURCE = [(2, "B", 20.0), (4, "D", 40.0), (None, "s-null", 9.0)]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


THRESHOLDS = ["-1", str(10 * 1024 * 1024)]      # sort-merge joins only; broadcasts by Spark's estimate


@pytest.fixture(params=THRESHOLDS)
def threshold(spark, request):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield request.param
    spark.conf.set(key, old)


@pytest.mark.parametrize("narrow", [True, False])
def test_merge_counts_and_rows(spark, ws, threshold, narrow):
    name = ws.name(f"t_{threshold.strip('-')}_{narrow}")
    publish(spark, spark.createDataFrame(TARGET, SCHEMA), name, "MERGE", "id",
            root=ws.table_root(name))
    res = publish(spark, spark.createDataFrame(SOURCE, SCHEMA), name, "MERGE", "id", narrow=narrow)
    assert (res.records_read, res.records_inserted, res.records_updated) == (3, 2, 1)
    got = sorted(spark.table(name).collect(), key=lambda r: (r.id is None, r.id or 0, r.name))
    assert [tuple(r) for r in got] == [(1, "a", 1.0), (2, "B", 20.0), (3, "c", 3.0), (4, "D", 40.0),
                                       (None, "s-null", 9.0), (None, "t-null", 0.0)]


def test_repeated_target_keys_are_all_updated(spark, ws, threshold):
    name = ws.name(f"r_{threshold.strip('-')}")
    publish(spark, spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0)], SCHEMA), name,
            "MERGE", "id", root=ws.table_root(name))
    res = publish(spark, spark.createDataFrame([(1, "new", 9.0)], SCHEMA), name, "MERGE", "id")
    assert _rows(spark.table(name)) == [(1, "new", 9.0), (1, "new", 9.0), (2, "c", 3.0)]
    assert (res.records_read, res.records_inserted, res.records_updated) == (1, 0, 2)


def test_source_sizes_on_both_sides_of_the_threshold(spark, ws):
    """One result whether Spark broadcasts the source or not."""
    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = spark.createDataFrame([("k%04d" % i + "x" * 500, i) for i in range(300)], "key string, v long")
    results = []
    try:
        for n, limit in enumerate(("-1", "20000", "100MB")):
            spark.conf.set(key, limit)
            name = ws.name(f"sizes_{n}")
            publish(spark, df.where("v < 200"), name, "MERGE", "key", root=ws.table_root(name))
            r = publish(spark, df.where("v >= 100").withColumn("v", F.col("v") + 1000), name, "MERGE", "key")
            results.append((r.counts(), _rows(spark.table(name))))
    finally:
        spark.conf.set(key, old)
    assert results[0] == results[1] == results[2]
    assert results[0][0]["records_inserted"] == 100 and results[0][0]["records_updated"] == 100


@pytest.mark.parametrize("narrow", [True, False])
def test_two_source_rows_for_a_target_row_fail_and_table_unchanged(spark, ws, narrow):
    name = ws.name(f"d_{narrow}")
    publish(spark, spark.createDataFrame(TARGET, SCHEMA), name, "MERGE", "id",
            root=ws.table_root(name))
    before = _rows(spark.table(name))
    dup = spark.createDataFrame([(2, "x", 1.0), (2, "y", 2.0)], SCHEMA)
    with pytest.raises(MergeCardinalityError):
        publish(spark, dup, name, "MERGE", "id", narrow=narrow)
    assert _rows(spark.table(name)) == before
    # repeats that match nothing are inserted, as MERGE does
    res = publish(spark, dup.withColumn("id", F.lit(77).cast("long")), name, "MERGE", "id", narrow=narrow)
    assert res.records_inserted == 2 and spark.table(name).where("id = 77").count() == 2


def test_idempotent_second_run_all_updates(spark, ws):
    name = ws.name("idem")
    src = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    publish(spark, src, name, "MERGE", "c_custkey", root=ws.table_root("idem"))
    first = _rows(spark.table(name))
    res = publish(spark, src, name, "MERGE", "c_custkey")
    assert _rows(spark.table(name)) == first
    assert res.records_updated == res.records_read == src.count() and res.records_inserted == 0


def test_composite_key(spark, ws):
    name = ws.name("comp")
    s = "a int, b int, v string"
    publish(spark, spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], s), name, "MERGE", "a, b",
            root=ws.table_root("comp"))
    res = publish(spark, spark.createDataFrame([(1, 2, "Y"), (2, 1, "z")], s), name, "MERGE",
                  " a ,b ")
    assert (res.records_inserted, res.records_updated) == (1, 1)
    assert _rows(spark.table(name)) == [(1, 1, "x"), (1, 2, "Y"), (2, 1, "z")]


def test_schema_fit_and_missing_column(spark, ws):
    name = ws.name("fit")
    publish(spark, spark.createDataFrame(TARGET[:2], SCHEMA), name, "MERGE", "id",
            root=ws.table_root("fit"))
    extra = spark.createDataFrame(SOURCE[:1], SCHEMA).withColumn("zzz", F.lit(1))
    publish(spark, extra, name, "MERGE", "id")
    assert spark.table(name).columns == ["id", "name", "amount"]
    with pytest.raises(ValueError):
        publish(spark, extra.drop("amount"), name, "MERGE", "id")


def test_load_type_errors(spark, ws):
    df = spark.createDataFrame(TARGET, SCHEMA)
    with pytest.raises(ValueError):
        publish(spark, df, ws.name("x"), "UPSERT", "id", root=ws.table_root("x"))
    with pytest.raises(ValueError):
        publish(spark, df, ws.name("x"), "MERGE", None, root=ws.table_root("x"))


def test_plans(spark):
    """No hints: Spark broadcasts a small source and sort-merges otherwise; each join scans the source once."""
    t = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    s = t.filter("c_acctbal > 5000")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        plan = merged(t, s, ["c_custkey"])._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("FileScan") == 4
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = merged(t, s, ["c_custkey"])._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan and "LeftOuter" in plan and "LeftAnti" in plan
        # the anti join reads only the target's key
        assert "ReadSchema: struct<c_custkey:bigint>" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_staged_source_is_evaluated_once(spark, ws):
    seen = spark.sparkContext.accumulator(0)

    def mark(v):
        seen.add(1)
        return v
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    name = ws.name("once")
    publish(spark, c, name, "MERGE", "c_custkey", root=ws.table_root("once"))
    source = c.withColumn("c_name", F.udf(mark, "string")("c_name"))
    publish(spark, source, name, "MERGE", "c_custkey")
    assert seen.value == c.count()


def test_staged_source_is_removed(spark, ws):
    import os
    from layerflow.session import scratch_schema, scratch_schema_location
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    name = ws.name("staged_gone")
    publish(spark, c, name, "MERGE", "c_custkey", root=ws.table_root("staged_gone"))
    publish(spark, c, name, "MERGE", "c_custkey")          # stages the source
    schema = scratch_schema(spark)
    assert [t.name for t in spark.catalog.listTables(schema) if "staged_gone" in t.name] == []
    folder = scratch_schema_location(spark)
    assert [d for d in os.listdir(folder) if "staged_gone" in d] == []


def test_clean_scratch_after_a_crash(spark, ws):
    """A run that died after staging leaves a scratch table; an orphan
    folder stands for one whose catalog entry died with the driver."""
    from layerflow.operators import tables as tb
    from layerflow.operators.publish import stage
    from layerflow.session import scratch_schema, scratch_schema_location
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    st = stage(spark, c, ws.name("crashed"))
    orphan = f"{scratch_schema_location(spark)}/lf_stage_orphan"
    c.write.parquet(orphan)
    assert tb.clean_scratch(spark, older_than_seconds=3600) == []
    removed = tb.clean_scratch(spark, older_than_seconds=0)
    assert any(r.endswith(st.table.split(".")[1]) for r in removed)
    assert any(r.endswith("lf_stage_orphan") for r in removed)
    assert st.table.split(".")[1] not in {t.name for t in spark.catalog.listTables(scratch_schema(spark))}


def test_source_profile(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 3), (1, None), (1, None)],
                               "a int, b int")
    assert source_profile(df, ["a", "b"]) == (6, False)      # rows with a NULL key part never match
    assert source_profile(df.union(spark.createDataFrame([(1, 2)], df.schema)), ["a", "b"]) == (7, True)
    assert source_profile(df.limit(0), ["a"]) == (0, False)
