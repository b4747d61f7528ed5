"""Packing small files: the same rows, only the listed files, whatever fails or is appended meanwhile."""

import datetime as dt

import pytest

from layerflow.operators import compaction as cp
from layerflow.operators import tables as tb
from layerflow.operators.publish import publish
from layerflow.plans.pipeline import Pipeline
from layerflow.plans.suite import _pipeline
from layerflow.session import RunContext

SCHEMA = "k int, v string, p string"
RULE = cp.AutoCompact(min_files=3)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def table_of(spark, ws, name, parts=("p",), appends=4):
    for n in range(appends):
        rows = [(n, "x", "a b/c"), (n, None, None)] + ([(n, "y", "one")] if not n else [])
        publish(spark, spark.createDataFrame(rows, SCHEMA), ws.name(name), "APPEND", root=ws.table_root(name), partition_by=list(parts))
    return ws.name(name)


@pytest.mark.parametrize("parts", [("p",), ()])
def test_rows_stay_and_only_small_files_go(spark, ws, parts):
    name = table_of(spark, ws, f"t{len(parts)}", parts)
    rows, before = rows_of(spark.table(name)), set(spark.table(name).inputFiles())
    assert cp.compact_appends(spark, name, cp.AutoCompact(min_files=9 if parts else 99)) == 0
    assert cp.compact_appends(spark, name, cp.AutoCompact(min_files=3, small_bytes=1)) == 0     # larger ones stay
    assert cp.compact_appends(spark, name, RULE) == (2 if parts else 1)
    after = set(spark.table(name).inputFiles())
    assert rows_of(spark.table(name)) == rows and len(after) == (3 if parts else 1)
    assert {f for f in before if "p=one" in f} <= after
    assert cp.compact_appends(spark, name, RULE) == 0
    publish(spark, spark.createDataFrame([(9, "z", "one")], SCHEMA), name, "APPEND")
    assert spark.table(name).count() == len(rows) + 1


def test_files_appended_meanwhile_stay(spark, ws, monkeypatch):
    name = table_of(spark, ws, "busy")
    rows, exchange = rows_of(spark.table(name)), cp._exchange

    def late(*a):
        publish(spark, spark.createDataFrame([(99, "late", "a b/c")], SCHEMA), name, "APPEND")
        exchange(*a)
    monkeypatch.setattr(cp, "_exchange", late)
    assert cp.compact_appends(spark, name, RULE) == 2
    assert rows_of(spark.table(name)) == sorted(rows + [(99, "late", "a b/c")], key=repr)


@pytest.mark.parametrize("at", ["write", "delete", "rename"])
def test_a_lost_run_is_finished(spark, ws, monkeypatch, at):
    """Lost before the journal, between two deletions, between two moves."""
    name = table_of(spark, ws, f"lost_{at}")
    rows = rows_of(spark.table(name))

    class Failing:
        def __init__(self, fs):
            self.fs, self.calls = fs, 0

        def __getattr__(self, key):
            def call(*a):
                self.calls += 1
                if self.calls == 2:
                    raise RuntimeError("lost")
                return getattr(self.fs, key)(*a)
            return call if key == at else getattr(self.fs, key)

    with monkeypatch.context() as m:
        if at == "write":
            m.setattr(cp._Files, "write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        else:
            exchange = cp._exchange

            def failing(files, aside, moves):
                files.fs = Failing(files.fs)
                exchange(files, aside, moves)
            m.setattr(cp, "_exchange", failing)
        with pytest.raises(RuntimeError, match="lost"):
            cp.compact_appends(spark, name, RULE)
    spark.catalog.refreshTable(name)
    assert cp.recover(spark, name) == (at != "write")
    assert rows_of(spark.table(name)) == rows
    assert not [p for p in cp._Files(spark, tb.table_location(spark, name)).below(
        cp._Files(spark, tb.table_location(spark, name)).root) if p.getName().startswith(cp.ASIDE)]


def test_added_columns_and_other_tables(spark, ws):
    name = table_of(spark, ws, "evolved")
    tb.add_column(spark, name, "w", "int")
    rows = rows_of(spark.table(name))
    assert cp.compact_appends(spark, name, RULE) == 2 and rows_of(spark.table(name)) == rows
    df = spark.createDataFrame([(k, "x", "a") for k in range(9)], SCHEMA)
    publish(spark, df, ws.name("ranges"), "MERGE", "k", root=ws.table_root("ranges"), range_rows=2)
    assert cp.compact_appends(spark, ws.name("ranges"), cp.AutoCompact(2)) == 0


def test_the_pipeline_packs_after_its_appends(spark):
    ws, p, cfg = _pipeline(spark, "/root/testdata/sf0.001", table_ids=("DIM_PRODUCT",), auto_compact=cp.AutoCompact(min_files=2))
    for day in (2, 3):
        Pipeline(spark, cfg, RunContext(f"r{day}", dt.datetime(2024, 2, day, tzinfo=dt.timezone.utc))).run_layer("DIM_PRODUCT", 0)
    raw = spark.table(ws.name("dim_product_raw"))
    assert len(raw.inputFiles()) == 1 and raw.select("job_run_id").distinct().count() == 2
