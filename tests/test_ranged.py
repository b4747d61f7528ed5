"""Tables clustered by key range: rows as a plain model has them, and only the touched ranges read and written."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerflow.operators import ranged as rg
from layerflow.operators import tables as tb
from layerflow.operators.publish import MergeCardinalityError, publish
from layerflow.operators.update import update_table
from layerflow.plans import audit as au
from layerflow.plans.suite import _pipeline

SCHEMA = "k string, d int, v int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def make(spark, ws, name, rows, size, schema=SCHEMA, key="k"):
    publish(spark, spark.createDataFrame(rows, schema), ws.name(name), "MERGE", key, root=ws.table_root(name), range_rows=size)
    return ws.name(name)


KEY = st.one_of(st.none(), st.text("ab é", max_size=3))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.dictionaries(KEY, st.integers(0, 9), max_size=12), min_size=2, max_size=3))
def test_equals_a_plain_model(spark, ws, batches):
    name, model, nulls = ws.name(f"m{abs(hash(str(batches)))}"), {}, 0
    for n, batch in enumerate(batches):
        df = spark.createDataFrame([(k, n, v) for k, v in batch.items()], SCHEMA)
        res = publish(spark, df, name, "MERGE", "k", root=ws.table_root(name), range_rows=4)
        assert res.records_read == len(batch)
        assert res.records_inserted == sum(k is None or k not in model for k in batch)
        assert res.records_updated == sum(k in model for k in batch)
        model.update({k: (k, n, v) for k, v in batch.items() if k is not None})
        nulls += None in batch
    got = rows_of(spark.table(name))
    assert [r for r in got if r[0] is not None] == sorted(model.values(), key=repr)
    assert sum(r[0] is None for r in got) == nulls
    live = rg.live_ranges(spark, name)
    assert sum(r[2] for r in live) == len(got) and live[0][1] is None and len({r[1] for r in live}) == len(live)


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 100])
def test_range_of_any_number_of_ranges(spark, n):
    ranges = [(f"r{k}", None if not k else k * 10) for k in range(n)]
    kind = spark.createDataFrame([], "k bigint").schema["k"].dataType
    df = spark.range(-5, n * 10 + 20).withColumn("r", rg.range_of(F.col("id"), ranges, kind))
    assert all(r.r == f"r{max(0, min(r.id // 10, n - 1))}" for r in df.collect())
    assert spark.range(1).select(rg.range_of(F.lit(None).cast("bigint"), ranges, kind)).first()[0] == "r0"


def test_untouched_ranges_are_neither_read_nor_written(spark, ws):
    name = make(spark, ws, "big", [(f"{k:05d}", 0, k) for k in range(2000)], 200)
    data = rg.data_table(name)
    before, files = {r[0] for r in rg.live_ranges(spark, name)}, set(spark.table(data).inputFiles())
    assert len(before) >= 10 and max(r[2] for r in rg.live_ranges(spark, name)) <= 200
    batch = spark.createDataFrame([(f"{k:05d}", 1, -k) for k in range(1950, 2050)], SCHEMA)
    publish(spark, batch, name, "MERGE", "k")
    after = {r[0] for r in rg.live_ranges(spark, name)}
    touched = before - after
    assert 1 <= len(touched) <= 2 and files <= set(spark.table(data).inputFiles())
    # the scan of the merge lists the touched partitions only
    scope = rg.in_ranges(spark.table(data), sorted(touched))
    plan = scope._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and all(f"{rg.RANGE}=" in f and f.split(f"{rg.RANGE}=")[1].split("/")[0] in touched
                                              for f in scope.inputFiles())
    assert spark.table(name).count() == 2050 and spark.table(name).where("d = 1").count() == 100
    assert rg.expire_ranges(spark, name, 3600) == 0 and rg.expire_ranges(spark, name, 0) == len(touched)
    assert spark.table(name).count() == 2050 and spark.table(name).columns == ["k", "d", "v"]


def test_a_lost_run_changes_nothing(spark, ws, monkeypatch):
    name = make(spark, ws, "lost", [(str(k), 0, k) for k in range(30)], 10)
    before = rows_of(spark.table(name))
    with monkeypatch.context() as m:
        m.setattr(tb, "switch_snapshot", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            publish(spark, spark.createDataFrame([("3", 1, 1), ("new", 1, 1)], SCHEMA), name, "MERGE", "k")
    assert rows_of(spark.table(name)) == before
    publish(spark, spark.createDataFrame([("3", 2, 2)], SCHEMA), name, "MERGE", "k")
    rg.expire_ranges(spark, name, 0)
    assert rows_of(spark.table(name)) == sorted([r for r in before if r[0] != "3"] + [("3", 2, 2)], key=repr)


def test_update_repeats_and_refusals(spark, ws):
    name = make(spark, ws, "upd", [(dt.date(2024, 1, 1 + k % 28), k, k) for k in range(56)], 8, "k date, d int, v int")
    before = {r[0] for r in rg.live_ranges(spark, name)}
    assert update_table(spark, name, {"v": F.lit(-1)}, F.col("d") == 5) == 1
    assert len(before - {r[0] for r in rg.live_ranges(spark, name)}) == 1
    assert update_table(spark, name, {"v": "d + 1"}, "d > 1000") == 0
    assert [r.v for r in spark.table(name).where("d = 5").collect()] == [-1]
    day = spark.createDataFrame([(dt.date(2024, 1, 6), 99, 99)], "k date, d int, v int")
    assert publish(spark, day, name, "MERGE", "k").records_updated == 2      # repeated target keys are all updated
    with pytest.raises(MergeCardinalityError):
        publish(spark, day.unionByName(day), name, "MERGE", "k")
    assert publish(spark, day, name, "MERGE", ["k", "d"], newer_by=["v"]).records_updated == 0
    for bad, call in (("clustered by k", lambda: update_table(spark, name, {"k": F.lit(None)})),
                      ("not a merge key", lambda: publish(spark, day, name, "MERGE", "d")),
                      ("MERGE into it", lambda: publish(spark, day, name, "APPEND")),
                      ("ranges are of", lambda: make(spark, ws, "dbl", [(1.5, 1, 1)], 5, "k double, d int, v int"))):
        with pytest.raises(ValueError, match=bad):
            call()


def test_pipeline_targets_in_ranges(spark):
    ws, p, cfg = _pipeline(spark, "/root/testdata/sf0.001", table_ids=("DIM_PRODUCT",), range_rows=40, expire_snapshots_after=0)
    flat, q, _ = _pipeline(spark, "/root/testdata/sf0.001", table_ids=("DIM_PRODUCT",))
    for x in (p, q, p, q):
        assert x.run_table("DIM_PRODUCT") == au.SUCCESS
    gold = ws.name("dim_product_gold")
    assert rg.is_ranged(spark, gold) and len(rg.live_ranges(spark, gold)) > 2
    assert rows_of(spark.table(gold)) == rows_of(spark.table(flat.name("dim_product_gold")))


def test_keys_are_sampled_before_any_shuffle(spark):
    """A first load has one range: a shuffle by range would bring all its keys to one task."""
    keys = spark.range(1000).select(F.when(F.col("id") >= 0, "only").alias(rg.RANGE), F.col("id").alias("k"))
    some = rg._sampled(keys, "k", {"only": 0.25, "none": 1.0})
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert 150 < some.count() < 350
    cuts = rg._cuts(keys, "k", {"only": 4}, {"only": 1000})["only"]
    assert len(cuts) == 3 and cuts == sorted(cuts) and all(150 < b - a < 350 for a, b in zip([0, *cuts], [*cuts, 1000]))
