"""Conditional MERGE: the target ends with the row that a dedup of everything that ever arrived would pick."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerflow.operators import tables as tb
from layerflow.operators.dedup import comes_before, dedup_latest
from layerflow.operators.publish import publish
from layerflow.plans import specs
from layerflow.plans import dims
from layerflow.plans.pipeline import TRANSFORMS, LayerContext
from layerflow.plans.suite import incremental_runs
from layerflow.session import RunContext

SF = "/root/testdata/sf0.001"
SCHEMA = "k string, ts int, v string, n int"
ROW = st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "x", "y"]),
                st.sampled_from([None, 0, 1]))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(arrivals=st.lists(st.lists(ROW, max_size=6), min_size=1, max_size=3), part=st.booleans())
def test_equals_a_dedup_of_all_arrivals(spark, ws, arrivals, part):
    order = [("ts", "desc"), ("v", "asc")]
    name = ws.name(f"t{abs(hash((str(arrivals), part)))}")
    parts, every = (["v"] if part else []), spark.createDataFrame([], SCHEMA)
    for rows in arrivals:
        df = spark.createDataFrame(rows, SCHEMA)
        every = every.unionByName(df)
        have = {r[0] for r in spark.table(name).collect()} if spark.catalog.tableExists(name) else set()
        before = rows_of(spark.table(name).select("k", "ts", "v", "n")) if have else []
        res = publish(spark, df, name, "MERGE", "k", root=ws.table_root(name), newer_by=order, partition_by=parts)
        after = rows_of(spark.table(name).select("k", "ts", "v", "n"))
        assert res.records_read == len(rows)
        assert res.records_inserted == len({r[0] for r in rows if r[0]} - have) + sum(r[0] is None for r in rows)
        changed = [r for r in after if r[0] in have and r[0] is not None and r not in before]
        assert res.records_updated >= len(changed)
    keyed = every.where("k IS NOT NULL")
    want = dedup_latest(keyed, ["k"], order).unionByName(every.where("k IS NULL"))
    assert rows_of(spark.table(name).select("k", "ts", "v", "n")) == rows_of(want)


def test_order_of_two_rows(spark):
    schema = spark.createDataFrame([], "k int, a int, b int, c int").schema
    df = spark.createDataFrame([(1, 1, 1, 1, 2, 0, 0), (1, 1, 1, 1, 1, 0, 0), (1, None, 1, 1, None, None, 9), (1, 1, 1, 1, None, 1, 1),
                                (1, 2, 2, 2, 2, 2, 2)], "k int, a int, b int, c int, _s_a int, _s_b int, _s_c int")
    got = [r.x for r in df.select(comes_before(schema, ["k"], ["a", ("b", "asc")], "_s_").alias("x")).collect()]
    # newer; equal, then smaller b; equal NULLs, NULL b first; NULL is last of a descending column; equal rows
    assert got == [True, True, True, False, False]


def test_an_older_arrival_changes_nothing(spark, ws):
    name = ws.name("old")
    publish(spark, spark.createDataFrame([("a", 5, "new", 1)], SCHEMA), name, "MERGE", "k", root=ws.table_root("old"),
            newer_by=["ts"], partition_by=["v"])
    res = publish(spark, spark.createDataFrame([("a", 4, "older", 1), ("a", None, "none", 1)], SCHEMA), name, "MERGE", "k",
                  newer_by=["ts"])
    assert (res.records_read, res.records_inserted, res.records_updated) == (2, 0, 0)
    assert rows_of(spark.table(name).select("k", "ts")) == [("a", 5)]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["v=new"]
    with pytest.raises(ValueError, match="newer_by"):
        publish(spark, spark.table(name), name, "APPEND", newer_by=["ts"])


def test_incremental_curation_reads_only_the_batch(spark):
    """The plan of the second run's source has one scan of the raw table, bounded below by the watermark."""
    ws, cfg = incremental_runs(spark, SF, True)
    spec = specs.lookup(spark.table(cfg.metadata_table), "DIM_CUSTOMER")
    run3 = RunContext("run-3", dt.datetime(2024, 1, 3, tzinfo=dt.timezone.utc))
    raw = ws.name("dim_customer_raw")
    new = spark.table(raw).limit(4).withColumn("ingestion_timestamp", F.lit(run3.run_ts).cast("timestamp"))
    publish(spark, new, raw, "APPEND")
    ctx = LayerContext(spark, spec, 1, run3, cfg)
    source = TRANSFORMS[f"{dims.CUSTOMER.name}.l1"].fn(ctx)
    plan = source._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThan(ingestion_timestamp" in plan
    assert "Join" not in plan and source.count() == 4
