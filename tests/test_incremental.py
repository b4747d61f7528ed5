import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerflow.operators import tables as tb
from layerflow.plans import audit as au
from layerflow.plans.pipeline import Pipeline
from layerflow.plans.suite import RUN1, incremental_runs
from layerflow.session import RunContext
from layerflow.sources.tables import WATERMARK_PROPERTY, next_batch, source_batch

RUN3 = RunContext("run-3", dt.datetime(2024, 1, 3, tzinfo=dt.timezone.utc))
SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.drop("gold_load_timestamp", "job_run_id").collect()),
                  key=repr)


def _two_runs(spark, incremental):
    return incremental_runs(spark, SF, incremental)


def test_incremental_equals_full_reread(spark):
    ws_i, cfg_i = _two_runs(spark, True)
    ws_f, _ = _two_runs(spark, False)
    gold_i = spark.table(ws_i.name("dim_customer_gold"))
    assert _rows(gold_i) == _rows(spark.table(ws_f.name("dim_customer_gold")))

    changed = spark.read.parquet(f"{SF}/customer.parquet").filter("c_acctbal > 5000").count()
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    st = au.latest_state(spark.table(cfg_i.audit_table)).filter(F.col("job_run_id") == "run-2")
    reads = {r.layer: (r.records_read, r.records_updated) for r in st.collect()}
    # layers 1 and 2 of the second run read only the changed rows
    assert reads == {"0": (changed, 0), "1": (changed, changed), "2": (changed, changed)}
    assert gold_i.count() == n
    assert WATERMARK_PROPERTY in tb.table_properties(spark, ws_i.name("dim_customer_gold"))


def test_nothing_new_keeps_snapshot_and_late_run_is_refused(spark):
    ws, cfg = _two_runs(spark, True)
    gold = ws.name("dim_customer_gold")
    loc = tb.table_location(spark, gold)
    p3 = Pipeline(spark, cfg, RUN3)
    assert p3.run_layer("DIM_CUSTOMER", 1) == au.SUCCESS
    assert p3.run_layer("DIM_CUSTOMER", 2) == au.SUCCESS
    assert tb.table_location(spark, gold) == loc
    st = au.latest_state(spark.table(cfg.audit_table)).filter(F.col("job_run_id") == "run-3")
    assert {r.records_read for r in st.collect()} == {0}
    # a landing stamped before the curated watermark would never be curated
    with pytest.raises(ValueError, match="not after the watermark"):
        Pipeline(spark, cfg, RUN1).run_layer("DIM_CUSTOMER", 0)


def test_next_batch_bounds(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    first, tok = next_batch(ev, "ts")
    assert first.count() == ev.count() and tok is not None
    rest, tok2 = next_batch(ev, "ts", tok)
    assert tok2 is None and rest.count() == 0
    ids = spark.range(10).withColumnRenamed("id", "k")
    b, t = next_batch(ids, "k", "6")
    assert sorted(r.k for r in b.collect()) == [7, 8, 9] and t == "9"
    # a load time is never NULL and never text
    nulls = spark.createDataFrame([(1, None, "a"), (2, 5, "b")], "id int, k int, s string")
    with pytest.raises(ValueError, match="never NULL"):
        next_batch(nulls, "k")
    with pytest.raises(ValueError, match="not a load time"):
        next_batch(nulls, "s")


def test_source_batch_loses_nothing(spark):
    rows = [(1, None, "x"), (2, 5, "9"), (3, 8, "11"), (4, 8, None)]
    df = spark.createDataFrame(rows, "id int, k int, s string")

    def ids(b):
        return sorted(r.id for r in b.collect())
    b, t = source_batch(df.where("id < 4"), "k")
    assert ids(b) == [1, 2, 3] and t == "8"
    b, t = source_batch(df, "k", t)              # the tie that came later, and the NULL
    assert ids(b) == [1, 3, 4] and t == "8"
    b, t = source_batch(df.where("k IS NULL"), "k")   # nothing but NULLs is read all the same
    assert ids(b) == [1] and t is None
    with pytest.raises(ValueError, match="text"):
        source_batch(df, "s")
    b, t = source_batch(df, "s", "9", "int")
    assert ids(b) == [1, 2, 3, 4] and t == "11"


def test_an_older_row_cannot_win(spark):
    """Key A has a dated row; a later batch brings an undated one: the history decides."""
    from layerflow.operators.dedup import dedup_latest
    from layerflow.sources.tables import history_of
    every = spark.createDataFrame([("A", "old", None, 1), ("A", "new", 5, 2), ("B", "b", 1, 3), ("A", "old", None, 3)],
                                  "k string, v string, ts int, load int")
    got = dedup_latest(history_of(every.where("load = 3"), every, {"k": F.col("k")}), ["k"], [("ts", "desc")])
    assert sorted((r.k, r.v) for r in got.collect()) == [("A", "new"), ("B", "b")]


def test_business_watermark_of_a_file_source_is_refused(spark):
    from layerflow.operators.update import update_table
    ws, cfg = _two_runs(spark, True)
    update_table(spark, cfg.metadata_table, {"watermark_column": F.lit("DEPTH")}, F.col("table_id") == "DIM_CUSTOMER")
    with pytest.raises(ValueError, match="text in a file source"):
        Pipeline(spark, cfg, RUN3).run_layer("DIM_CUSTOMER", 0)


def test_stream_landing_lands_only_new_files(spark):
    ws, cfg = incremental_runs(spark, SF, stream=True)
    gold, raw = ws.name("dim_customer_gold"), ws.name("dim_customer_raw")
    n_raw, loc = spark.table(raw).count(), tb.table_location(spark, gold)
    assert Pipeline(spark, cfg, RUN3).run_table("DIM_CUSTOMER") == au.SUCCESS
    st = au.latest_state(spark.table(cfg.audit_table)).filter(F.col("job_run_id") == "run-3")
    assert {r.layer: r.records_read for r in st.collect()} == {"0": 0, "1": 0, "2": 0}
    assert spark.table(raw).count() == n_raw
    assert tb.table_location(spark, gold) == loc


def test_landed_rows_are_counted_by_the_append(spark, ws):
    """Many micro-batches: the count does not come from the last progress records."""
    from layerflow.streaming.landing import land_available
    c = spark.read.parquet(f"{SF}/region.parquet").selectExpr("CAST(r_regionkey AS STRING) AS a")
    drop = ws.stage(c, "many")
    for _ in range(4):
        from layerflow.sources.files import stage_csv
        stage_csv(c, drop, mode="append")
    name, schema = ws.name("many"), "a string, source_file_name string, ingestion_timestamp timestamp, job_run_id string"
    tb.create_table(spark, name, spark.createDataFrame([], schema).schema, ws.table_root("many"))
    ckpt = f"{ws.root}/ckpt-many"
    assert land_available(spark, drop, ["a"], name, RUN1, ckpt, max_files_per_trigger=1) == 5 * c.count()
    assert land_available(spark, drop, ["a"], name, RUN1, ckpt) == 0 and spark.table(name).count() == 5 * c.count()


def test_landing_by_header_name(spark, ws):
    from layerflow.sources.files import read_csv_strings, stage_csv
    df = spark.createDataFrame([("1", "x", "é,é"), ("2", None, "q")], "a string, b string, c string")
    path = ws.stage(df, "hdr")
    stage_csv(df.select("c", "b", "a"), path, mode="append")
    got = sorted(tuple(r)[:3] for r in read_csv_strings(spark, path, ["a", "b", "c"]).collect())
    assert got == sorted([("1", "x", "é,é"), ("2", None, "q")] * 2, key=repr)
    stage_csv(df.select("c", "a"), path, mode="append")
    with pytest.raises(ValueError, match=r"lacks columns \['b'\]"):
        read_csv_strings(spark, path, ["a", "b", "c"])


def test_watermark_bounds_reach_the_scan(spark, ws):
    """Both bounds of a batch are pushed into the Parquet scan of the
    upstream table (row groups outside the batch are skipped)."""
    from layerflow.operators.publish import publish as pub
    ev = spark.read.parquet(f"{SF}/events.parquet")
    name = ws.name("ev_hist")
    pub(spark, ev.withColumn("ts", F.col("ts").cast("timestamp")), name, "APPEND", root=ws.table_root("ev_hist"))
    tok = "1705276800000000"        # 2024-01-15 in microseconds
    batch, _ = next_batch(spark.table(name), "ts", tok)
    plan = batch._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("]", 1)[0]
    assert "GreaterThan(ts," in pushed and "LessThanOrEqual(ts," in pushed, pushed
