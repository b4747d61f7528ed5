import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerflow.operators import tables as tb
from layerflow.operators.publish import publish
from layerflow.plans import audit as au
from layerflow.plans import specs
from layerflow.plans.pipeline import Pipeline, PipelineConfig, RunFailed, register
from layerflow.plans.suite import RUN2, _dimension_metadata, _drops


def test_audit_events_and_latest_state(spark, ws):
    t = ws.name("audit")
    au.ensure_audit_table(spark, t, ws.table_root("audit"))
    h1 = au.start_run(spark, t, RUN2, "T1", 0, "FILE")
    au.end_run(spark, t, h1, au.SUCCESS, 5, 5, 0)
    h2 = au.start_run(spark, t, RUN2, "T2", 1)
    msg = "it's \\ broken\n\"quoted\""
    au.end_run(spark, t, h2, au.REJECTED, error_message=msg)
    au.start_run(spark, t, RUN2, "T3", 2)
    st = {r.table_name: r for r in au.latest_state(spark.table(t)).collect()}
    assert st["T1"].status == au.SUCCESS and st["T1"].records_read == 5
    assert st["T2"].status == au.REJECTED and st["T2"].error_message == msg
    assert st["T3"].status == au.RUNNING and st["T3"].end_time is None
    assert spark.table(t).count() == 5
    au.compact(spark, t)
    assert spark.table(t).count() == 5


def _pipeline(spark, ws, active=(True, True, True), ids=("DIM_PRODUCT",), extra=None):
    meta = ws.name("meta")
    tb.create_table(spark, meta, specs.METADATA_SCHEMA, ws.table_root("meta"))
    rows = _dimension_metadata(ws, _drops(ws, ids), active, ids) + (extra or [])
    publish(spark, specs.metadata_frame(spark, rows), meta, "APPEND")
    cfg = PipelineConfig(meta, ws.name("audit"), f"{ws.root}/tables")
    return Pipeline(spark, cfg, RUN2), cfg


def test_run_table_counts_rejects(spark, ws):
    p, cfg = _pipeline(spark, ws)
    assert p.run_table("DIM_PRODUCT") == au.SUCCESS
    st = au.latest_state(spark.table(cfg.audit_table)).orderBy("layer").collect()
    n = spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()
    assert [(r.layer, r.status, r.records_read) for r in st] == [
        ("0", "SUCCESS", 2 * n), ("1", "SUCCESS", n), ("2", "SUCCESS", n)]
    assert st[1].records_rejected > 0
    rej = spark.table(ws.name("dim_product_curated_rejects"))
    assert rej.count() == st[1].records_rejected
    gold = spark.table(ws.name("dim_product_gold"))
    assert gold.count() == n and "product_category_path" in gold.columns
    assert gold.count() == spark.table(ws.name("dim_product_curated")).count()
    ev = spark.table(cfg.audit_table)
    assert au.latest_state(ev).count() == ev.select("audit_id").distinct().count() == 3
    assert tb.not_null_columns(spark, ws.name("dim_product_gold")) == ["product_id"]


def test_skip_stops_table(spark, ws):
    p, cfg = _pipeline(spark, ws, active=(True, False, True))
    assert p.run_table("DIM_PRODUCT") == au.SKIPPED
    st = au.latest_state(spark.table(cfg.audit_table)).orderBy("layer").collect()
    assert [(r.layer, r.status) for r in st] == [("0", "SUCCESS"), ("1", "SKIPPED")]
    assert not spark.catalog.tableExists(ws.name("dim_product_gold"))


@register("always_fails")
def _fails(ctx):
    raise RuntimeError("can't load: bad 'input'")


def test_failure_is_audited_and_raised(spark, ws):
    p, cfg = _pipeline(spark, ws, ids=("DIM_ENTITIES",))
    meta = cfg.metadata_table
    from layerflow.operators.update import update_table
    update_table(spark, meta, {"layer1_script_path": F.lit("always_fails")},
                 F.col("table_id") == "DIM_ENTITIES")
    with pytest.raises(RuntimeError, match="bad 'input'"):
        p.run_table("DIM_ENTITIES")
    st = {r.layer: r for r in au.latest_state(spark.table(cfg.audit_table)).collect()}
    assert st["1"].status == au.REJECTED and st["1"].error_message == "can't load: bad 'input'"
    assert "2" not in st
    with pytest.raises(RunFailed, match="DIM_ENTITIES: can't load") as e:
        p.run_active()
    assert e.value.status == {"DIM_ENTITIES": au.REJECTED}


def test_failed_lookup_is_audited_and_raised(spark, ws):
    """A duplicate metadata id runs no layer, but leaves an audit row, and the others run."""
    p, cfg = _pipeline(spark, ws, ids=("DIM_ENTITIES",), extra=[{"table_id": "TWICE"}, {"table_id": "TWICE"}])
    with pytest.raises(RunFailed, match="more than one row for TWICE") as e:
        p.run_active(max_parallel=2)
    assert e.value.status == {"DIM_ENTITIES": au.SUCCESS, "TWICE": au.REJECTED}
    st = {(r.table_name, r.layer): r for r in au.latest_state(spark.table(cfg.audit_table)).collect()}
    assert st["TWICE", "0"].status == au.REJECTED and "more than one" in st["TWICE", "0"].error_message
    assert st["DIM_ENTITIES", "2"].status == au.SUCCESS


def test_rejects_are_kept_once_and_as_raw_text(spark, ws):
    p, cfg = _pipeline(spark, ws)
    for _ in range(2):
        assert p.run_table("DIM_PRODUCT") == au.SUCCESS
    rej = spark.table(ws.name("dim_product_curated_rejects"))
    bad = spark.read.parquet("/root/testdata/sf0.001/part.parquet").where("p_size IN (1, 3, 7)").count()
    assert rej.count() == 2 * bad > 0          # both landed versions, once each
    assert {r.PACK.strip() for r in rej.where("rejected_columns = 'pack'").collect()} == {"n/a"}
    assert {r.CYLINDER_QTY.strip() for r in rej.where("rejected_columns = 'cylinder_qty'").collect()} <= {"x", "1.5"}
    from layerflow.session import RunContext
    p2 = Pipeline(spark, cfg, RunContext("another", RUN2.run_ts))
    p2.run_layer("DIM_PRODUCT", 1)
    assert {r.job_run_id for r in rej.sparkSession.table(ws.name("dim_product_curated_rejects")).collect()} == {"run-2", "another"}


def test_lookup_errors_and_active_list(spark):
    meta = specs.metadata_frame(spark, [
        {"table_id": "B", "table_group": "FACT"}, {"table_id": "A", "table_group": "DIMENSION"},
        {"table_id": "C", "table_is_active": None}, {"table_id": "D", "table_is_active": False},
        {"table_id": "A"}])
    assert [r.table_id for r in specs.active_tables(meta).collect()] == ["A", "A", "B"]
    assert [r.table_id for r in specs.active_tables(meta, "FACT").collect()] == ["B"]
    with pytest.raises(LookupError, match="not found"):
        specs.lookup(meta, "Z")
    with pytest.raises(LookupError, match="more than one"):
        specs.lookup(meta, "A")
    assert specs.lookup(meta, "B").table_group == "FACT"


def test_audit_log_compaction_is_maintenance(spark, ws):
    p, cfg = _pipeline(spark, ws, ids=("DIM_ENTITIES",))
    assert p.run_table("DIM_ENTITIES") == au.SUCCESS
    ev = spark.table(cfg.audit_table)
    assert len(ev.inputFiles()) >= 6 and ev.count() == 6
    assert {r.executed_by for r in ev.collect()} == {spark.sql("SELECT current_user()").first()[0]}
    au.compact(spark, cfg.audit_table)
    ev = spark.table(cfg.audit_table)
    assert len(ev.inputFiles()) < 6 and ev.count() == 6
    assert sorted((r.layer, r.status) for r in au.latest_state(ev).collect()) == [
        ("0", "SUCCESS"), ("1", "SUCCESS"), ("2", "SUCCESS")]


def test_partition_column_applies_where_present(spark, ws):
    """``country`` exists in curated and gold only; both get partitioned,
    raw does not, and the rows equal an unpartitioned run's."""
    p, cfg = _pipeline(spark, ws, ids=("DIM_CUSTOMER",))
    from layerflow.operators.update import update_table
    update_table(spark, cfg.metadata_table, {"partition_column": F.lit("country")},
                 F.col("table_id") == "DIM_CUSTOMER")
    assert p.run_table("DIM_CUSTOMER") == au.SUCCESS
    assert p.run_table("DIM_CUSTOMER") == au.SUCCESS      # second run merges
    assert tb.partition_columns(spark, ws.name("dim_customer_raw")) == []
    assert tb.partition_columns(spark, ws.name("dim_customer_gold")) == ["country"]
    from layerflow.plans.suite import Workspace
    ws2 = Workspace(spark, "/root/testdata/sf0.001")
    p2, _ = _pipeline(spark, ws2, ids=("DIM_CUSTOMER",))
    p2.run_table("DIM_CUSTOMER")

    def rows(w):   # by name: a partitioned table lists its partition columns last
        return sorted(str(sorted(r.asDict().items())) for r in
                      spark.table(w.name("dim_customer_gold")).drop("gold_load_timestamp").collect())
    assert rows(ws) == rows(ws2)


def test_pipeline_expires_old_snapshots(spark, ws):
    import os
    from layerflow.plans.pipeline import Pipeline, PipelineConfig
    _, cfg = _pipeline(spark, ws, ids=("DIM_ENTITIES",))
    p = Pipeline(spark, PipelineConfig(cfg.metadata_table, cfg.audit_table, cfg.root,
                                       expire_snapshots_after=0), RUN2)
    for _ in range(3):
        assert p.run_table("DIM_ENTITIES") == au.SUCCESS
    gold = ws.name("dim_entities_gold")
    root = tb.table_location(spark, gold).split(":", 1)[-1].rsplit("/", 1)[0]
    assert [d for d in os.listdir(root) if d.startswith("snap-")] == \
        [tb.table_location(spark, gold).rsplit("/", 1)[1]]
    assert spark.table(gold).count() == spark.read.parquet(
        "/root/testdata/sf0.001/supplier.parquet").count()


def test_buffered_events_are_few_files_and_survive_failures(spark):
    """Three tables, one failing: one file for the run; a log by day is read in the days asked for."""
    from layerflow.operators.update import update_table
    from layerflow.plans.suite import _pipeline as pipeline
    ws, p, cfg = pipeline(spark, "/root/testdata/sf0.001", buffered_audit=True)
    update_table(spark, cfg.metadata_table, {"layer1_script_path": F.lit("missing.l1")}, F.col("table_id") == "DIM_CUSTOMER")
    with pytest.raises(RunFailed):
        p.run_active(max_parallel=3)
    log = spark.table(cfg.audit_table)
    assert len(log.inputFiles()) <= 2 and log.count() == 2 * 8      # two days if it is midnight
    days = {r[au.DAY] for r in log.select(au.DAY).distinct().collect()}
    st = au.latest_state(log, min(days), max(days))
    assert st.count() == 8 and st.where("status = 'REJECTED'").count() == 1
    assert "PartitionFilters: [isnotnull(audit_date" in st._jdf.queryExecution().executedPlan().toString()
    assert au.latest_state(log, last_day=min(days) - dt.timedelta(days=1)).count() == 0


def test_buffer_is_flushed_when_its_oldest_event_waits(spark, ws):
    t = ws.name("audit_log")
    au.ensure_audit_table(spark, t, ws.table_root("audit"), by_day=True)
    now = [dt.datetime(2024, 1, 1, 23, 59, tzinfo=dt.timezone.utc)]
    log = au.AuditLog(spark, t, RUN2, buffered=True, flush_seconds=60, clock=lambda: now[0])
    with pytest.raises(RuntimeError, match="driver"):
        with log.run_of():
            h = log.start("T", 0)
            assert spark.table(t).count() == 0
            now[0] += dt.timedelta(seconds=61)
            with log.run_of():
                log.start("T", 1)
            assert spark.table(t).count() == 2      # a long run shows as RUNNING
            log.end(h, au.SUCCESS, records_read=3)
            raise RuntimeError("driver")
    st = {r.layer: (r.status, str(r[au.DAY])) for r in au.latest_state(spark.table(t)).collect()}
    # both events of a layer are in the partition of its start
    assert st == {"0": (au.SUCCESS, "2024-01-01"), "1": (au.RUNNING, "2024-01-02")}
