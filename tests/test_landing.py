"""Landing: headers off the driver, malformed lines, repeated runs, late rows."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from layerflow.operators import tables as tb
from layerflow.operators.publish import publish
from layerflow.plans import audit as au
from layerflow.plans import specs
from layerflow.plans.pipeline import LayerContext, Pipeline, PipelineConfig, register
from layerflow.plans.suite import RUN1, RUN2, _malformed_runs, _pipeline
from layerflow.plans.transforms import land_checked
from layerflow.session import RunContext
from layerflow.sources import files, landed
from layerflow.sources.files import read_csv_strings
from layerflow.sources.tables import late_batch, source_batch, too_late
from layerflow.streaming.landing import Landed, file_lander, land_available

SF = "/root/testdata/sf0.001"
RAW = "a string, b string, source_file_name string, ingestion_timestamp timestamp, job_run_id string"


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)
    return folder


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def driver_calls(spark, monkeypatch, action):
    """Calls from Python to the driver's JVM during ``action``."""
    client, n = spark.sparkContext._gateway._gateway_client, []
    send = client.send_command
    with monkeypatch.context() as m:
        m.setattr(client, "send_command", lambda c, *a, **k: (n.append(0) if not c.startswith("m\n") else None, send(c, *a, **k))[1])
        action()
    return len(n)


def test_agreeing_files_need_no_call_per_file(spark, folder, monkeypatch):
    """One job opens all files: neither the second pass nor a call per file is made."""
    monkeypatch.setattr(files, "header_layouts", lambda *a: pytest.fail("a second pass over the headers"))
    calls = []
    for n in (2, 40):
        for k in range(n):
            write(f"{folder}/{n}", f"f {k}.csv", f"a,b\n{k},x\n")
        write(f"{folder}/{n}", "empty.csv", "")
        read_csv_strings(spark, f"{folder}/{n}", ["a", "b"])     # what is only called once, is
        calls.append(driver_calls(spark, monkeypatch, lambda: read_csv_strings(spark, f"{folder}/{n}", ["a", "b"])))
        assert read_csv_strings(spark, f"{folder}/{n}", ["a", "b"]).count() == n
    assert calls[0] == calls[1], calls


def test_mixed_files_are_read_by_their_own_headers(spark, folder):
    write(folder, "one.csv", "a,b\n1,2\n")
    write(folder, "two [x] {y}.csv", "\n﻿b,a,c\n4,3,9\n".lstrip("\n"))
    write(folder, "three é.csv", "b,a\n6,5\n8,7\n")
    assert rows_of(read_csv_strings(spark, folder, ["a", "b"]), "a", "b") == [("1", "2"), ("3", "4"), ("5", "6"), ("7", "8")]
    layouts = files.header_layouts(spark, folder)
    assert {h: len(f) for h, f in layouts.items()} == {("a", "b"): 1, ("b", "a", "c"): 1, ("b", "a"): 1}
    write(folder, "four.csv", "a\n1\n")
    with pytest.raises(ValueError, match=r"four.csv.*lacks columns \['b'\]"):
        read_csv_strings(spark, folder, ["a", "b"])


def test_session_settings_stay(spark, folder):
    write(folder, "one.csv", "a,b\n1,2\n")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    files.headers_agree(spark, folder, ["a", "b"])
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert not files.headers_agree(spark, folder, ["a", "c"]) and not files.headers_agree(spark, folder, ["a"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.headers_agree(spark, folder + "/none", ["a"])


def test_malformed_lines(spark, folder):
    write(folder, "m.csv", 'a,b\n1,2\n3\n"x,y",4\n5,6,7\n\n,8\n')
    write(folder, "n.csv", "b,a\n9\n10,11\n")
    rows, lines, seen = land_checked(spark, folder, RUN1, ["a", "b"])
    assert rows_of(rows, "a", "b") == sorted([("1", "2"), ("x,y", "4"), (None, "8"), ("11", "10")], key=repr)
    assert seen.get["malformed"] == 3
    assert rows_of(lines.withColumn("f", F.regexp_extract("source_file_name", r"[^/]+$", 0)), "f", "raw_line", "job_run_id") == [
        ("m.csv", "3", "run-1"), ("m.csv", "5,6,7", "run-1"), ("n.csv", "9", "run-1")]
    assert rows_of(lines, "raw_line") == [("3",), ("5,6,7",), ("9",)]


def test_a_clean_drop_writes_no_reject_table_and_is_read_once(spark):
    ws, p, cfg = _pipeline(spark, SF, table_ids=("DIM_PRODUCT",))
    p.run_layer("DIM_PRODUCT", 0)
    assert not spark.catalog.tableExists(ws.name("dim_product_raw_rejects"))


@pytest.mark.parametrize("stream", [False, True])
def test_malformed_lines_in_the_audit(spark, stream):
    ws, cfg = _malformed_runs(spark, SF, stream)
    part = spark.read.parquet(f"{SF}/part.parquet")
    n, bad = part.count(), part.where("p_size <= 5 OR p_size > 45").count()
    got = [(r.records_read, r.records_inserted, r.records_rejected) for r in
           spark.table(cfg.audit_table).where("status = 'SUCCESS'").collect()]
    assert bad and sorted(got) == sorted([(n, n - bad, bad), (0, 0, 0) if stream else (n, n - bad, bad)])
    assert spark.table(ws.name("parts_raw_rejects")).count() == bad


def test_a_repeated_stream_batch_rejects_no_line_twice(spark, ws, folder):
    write(folder, "m.csv", "a,b\n1,2\n3\n")
    name, bad = ws.name("s_raw"), ws.name("s_bad")
    tb.create_table(spark, name, spark.createDataFrame([], RAW).schema, ws.table_root("s_raw"))
    from layerflow.plans.transforms import MALFORMED_SCHEMA
    tb.create_table(spark, bad, MALFORMED_SCHEMA, ws.table_root("s_bad"))
    batch = landed.drop_files(spark, folder).select("file")
    for _ in range(2):       # the second time as the first batch of a new run
        rejected = Landed()
        file_lander(["a", "b"], RUN1, name, Landed(), bad, rejected)(batch, 0)
    assert spark.table(name).count() == 1 and spark.table(bad).count() == 1 and rejected.rows == 0


def test_stream_names_the_file_that_lacks_a_column(spark, ws, folder):
    write(folder, "good.csv", "a,b\n1,2\n")
    write(folder, "wrong.csv", "a,c\n1,2\n")
    name = ws.name("wrong_raw")
    tb.create_table(spark, name, spark.createDataFrame([], RAW).schema, ws.table_root("wrong_raw"))
    with pytest.raises(Exception, match=r"wrong.csv.*lacks columns \['b'\]"):
        land_available(spark, folder, ["a", "b"], name, RUN1, f"{ws.root}/ck")
    assert spark.table(name).count() == 0


# ------------------------------------------------------------ repeated batch landings

def land_once(spark, ws, drop, run, fail=None):
    """One landing as the pipeline does it; ``fail`` stops it after that step."""
    name = ws.name("once")

    def count_rows(paths):
        return land_checked(spark, paths, run, ["a", "b"])[0].groupBy(F.col("source_file_name").alias("file")).agg(
            F.count("*").alias("n"))
    landing = landed.begin_landing(spark, drop, name, name + "_landed", ws.table_root("once_landed"), run, count_rows)
    if fail == "begin" or not landing.files:
        return len(landing.files)
    rows, _, _ = land_checked(spark, landing.files, run, ["a", "b"])
    publish(spark, rows, name, "APPEND", root=ws.table_root("once"))
    if fail != "append":
        landing.commit()
    return len(landing.files)


def test_lost_runs_are_completed(spark, ws, folder):
    write(folder, "x.csv", "a,b\n1,2\n3,4\n5\n")
    assert land_once(spark, ws, folder, RUN1, fail="begin") == 1       # lost before the append
    assert land_once(spark, ws, folder, RUN1, fail="append") == 1      # lost before the mark
    assert land_once(spark, ws, folder, RUN2) == 0 and spark.table(ws.name("once")).count() == 2
    assert land_once(spark, ws, folder, RUN2) == 0
    write(folder, "y [1].csv", "b,a\n1,2\n")
    assert land_once(spark, ws, folder, RUN2) == 1 and spark.table(ws.name("once")).count() == 3
    os.utime(f"{folder}/x.csv", (1, 1))                               # another version of the same file
    assert land_once(spark, ws, folder, RUN2) == 1 and spark.table(ws.name("once")).count() == 5


def test_half_an_append_is_an_error(spark, ws, folder):
    write(folder, "x.csv", "a,b\n1,2\n3,4\n")
    assert land_once(spark, ws, folder, RUN1, fail="append") == 1
    tb.replace_rows(spark, ws.name("once"), spark.table(ws.name("once")).limit(1))
    with pytest.raises(landed.PartialAppend, match="1 of 2 rows of .*x.csv"):
        land_once(spark, ws, folder, RUN2)


# ------------------------------------------------------------ late rows

def test_late_rows_within_the_window(spark):
    schema = "id int, d date, v string"
    day = lambda n: dt.date(2024, 1, n)
    first = spark.createDataFrame([(1, day(1), "a"), (2, day(10), "b"), (3, None, "n")], schema)
    batch, token = source_batch(first, "d")
    late = [(4, day(9), None), (5, day(7), ""), (6, day(6), "too late"), (7, None, "n2"), (8, day(11), "new")]
    source = first.unionByName(spark.createDataFrame(late, schema))
    for raw in (first, first.select(*[F.col(c).cast("string").alias(c) for c in first.columns])):
        new, after = late_batch(source, raw, "d", token, "3 days")
        assert sorted(r.id for r in new.collect()) == [4, 5, 7, 8] and after == "2024-01-11"
        assert [r.id for r in too_late(source, raw, "d", token, "3 days").collect()] == [6]
    new, _ = late_batch(source, first, "d", None, "3 days")
    assert new.count() == 8
    with pytest.raises(ValueError, match="not a span"):
        late_batch(source, first, "d", token, "x'; DROP")


def test_late_rows_of_numbers_and_text(spark):
    source = spark.createDataFrame([(k, str(k)) for k in (1, 8, 9, 10, 11)], "k int, s string")
    raw = source.where("k IN (1, 10)")
    assert sorted(r.k for r in late_batch(source, raw, "k", "10", 2)[0].collect()) == [8, 9, 11]
    assert sorted(r.k for r in late_batch(source, raw, "s", "10", 1, "int")[0].collect()) == [9, 11]
    with pytest.raises(ValueError, match="text"):
        late_batch(source, raw, "s", "10", 1)


def test_late_rows_of_a_pipeline_source(spark):
    """``source_rows`` with a lateness window, against the raw table it fills."""
    ws, p, cfg = _pipeline(spark, SF, table_ids=("DIM_PRODUCT",), lateness="2 days")
    spec = specs.lookup(spark.table(cfg.metadata_table), "DIM_PRODUCT")
    object.__setattr__(spec, "watermark_column", "d")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 5))], "id int, d date")
    ctx = LayerContext(spark, spec, 0, RUN1, cfg)
    batch = ctx.source_rows(df, "src")
    name = ctx.target.table_name
    publish(spark, batch, name, "APPEND", root=ws.table_root("raw"))
    from layerflow.sources.tables import WATERMARK_PROPERTY, encode_watermark
    tb.set_properties(spark, name, {WATERMARK_PROPERTY: encode_watermark(*ctx.watermark)})
    more = df.unionByName(spark.createDataFrame([(2, dt.date(2024, 1, 3)), (3, dt.date(2024, 1, 2))], df.schema))
    assert [r.id for r in LayerContext(spark, spec, 0, RUN2, cfg).source_rows(more, "src").collect()] == [2]


# ------------------------------------------------------------ isolation

SEEN = {}


@register("slow_land")
def _slow(ctx):
    SEEN[ctx.spec.table_id] = (ctx.spark.sparkContext.getLocalProperty("spark.scheduler.pool"),
                               set(ctx.spark.sparkContext.getLocalProperty("spark.job.tags").split(",")))
    n = 10**13 if ctx.spec.table_id == "SLOW" else 10
    return ctx.spark.range(0, n, 1, 2).where("id % 7 = 3")


def test_pools_tags_and_a_cancelled_table(spark, ws):
    meta = ws.name("meta")
    tb.create_table(spark, meta, specs.METADATA_SCHEMA, ws.table_root("meta"))
    publish(spark, specs.metadata_frame(spark, [{
        "table_id": t, "source_system": "FILE", "table_is_active": True, "layer0_target_schema": ws.schema,
        "layer0_target_table": f"{t.lower()}_raw", "layer0_is_active": True, "layer0_script_path": "slow_land",
        "layer0_load_type": "APPEND"} for t in ("SLOW", "QUICK")]), meta, "APPEND")
    cfg = PipelineConfig(meta, ws.name("log"), f"{ws.root}/tables", table_timeout=8)
    from layerflow.plans.pipeline import RunFailed
    began = time.time()
    with pytest.raises(RunFailed) as e:
        Pipeline(spark, cfg, RunContext("iso", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))).run_active(max_parallel=2)
    assert set(e.value.errors) == {"SLOW"} and time.time() - began < 90
    st_ = {(r.table_name, r.layer): (r.status, r.error_message) for r in au.latest_state(spark.table(cfg.audit_table)).collect()}
    assert st_[("SLOW", "0")][0] == au.REJECTED and "limit of 8 s" in st_[("SLOW", "0")][1]
    assert st_[("QUICK", "0")][0] == au.SUCCESS and spark.table(ws.name("quick_raw")).count() == 1
    (pool_a, tags_a), (pool_b, tags_b) = SEEN["SLOW"], SEEN["QUICK"]
    assert (pool_a, pool_b) == ("SLOW", "QUICK") and len(tags_a) == len(tags_b) == 1 and not tags_a & tags_b
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
