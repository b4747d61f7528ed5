import datetime as dt
import decimal
import os

import pytest

from pyspark.sql import functions as F

from layerflow.functions import cleaning as C
from layerflow.functions.rules import REJECT_COLUMN, ColumnRule, apply_rules
from layerflow.sources.files import read_csv_strings


def _one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_csv_empty_and_quoted_empty_are_null(spark, folder):
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w") as fh:
        fh.write('A,B,C\n,"", \n"x\ty",z,\n')
    rows = read_csv_strings(spark, folder, ["A", "B", "C"]).collect()
    assert (rows[0].A, rows[0].B, rows[0].C) == (None, None, " ")
    assert rows[1].A == "x\ty"


def test_csv_columns_come_by_header_name(spark, folder):
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w") as fh:
        fh.write("B,A\n1,2\n")
    got = read_csv_strings(spark, folder, ["A", "B"]).collect()
    assert [(r.A, r.B) for r in got] == [("2", "1")]
    with pytest.raises(ValueError, match="lacks columns"):
        read_csv_strings(spark, folder, ["A", "C"])


def test_typed_int_rules(spark):
    df = _one_col(spark, [" 5 ", " ", "x", "1.5", None, ""])
    r = ColumnRule("n", "v", "cast", "int")
    out = apply_rules(df, [r], track_rejects=True).collect()
    assert [o.n for o in out] == [5, None, None, None, None, None]
    assert [o[REJECT_COLUMN] for o in out] == ["", "", "n", "n", "", ""]


def test_typed_decimal_rounding(spark):
    df = _one_col(spark, [" 2 ", "1.123445", "1.123444", "n/a"])
    out = df.select(C.typed("v", "decimal(18,5)").alias("d")).collect()
    assert [o.d for o in out] == [decimal.Decimal("2.00000"), decimal.Decimal("1.12345"),
                                  decimal.Decimal("1.12344"), None]


def test_typed_timestamp(spark):
    df = _one_col(spark, ["2024-03-05 10:00:00", "01/02/2024", ""])
    r = ColumnRule("t", "v", "cast", "timestamp")
    out = apply_rules(df, [r], track_rejects=True).select(
        F.col("t").cast("string").alias("t"), REJECT_COLUMN).collect()
    assert [o.t for o in out] == ["2024-03-05 10:00:00", None, None]
    assert [o[REJECT_COLUMN] for o in out] == ["", "t", ""]


def test_flag(spark):
    df = _one_col(spark, ["y", " Y ", "N", "", None])
    assert [o.f for o in df.select(C.flag("v").alias("f")).collect()] == [True, True, False, False, None]


def test_trim_keeps_tab_and_newline(spark):
    df = _one_col(spark, ["\ta ", " b\n", "  "])
    assert [o.t for o in df.select(C.clean_text("v").alias("t")).collect()] == ["\ta", "b\n", ""]


def test_paths(spark):
    df = spark.createDataFrame([("a", None, "c", None), (None, None, None, None)],
                               "l1 string, l2 string, l3 string, l4 string")
    got = [r.p for r in df.select(C.hierarchy_path("l1", "l2", "l3", "l4").alias("p")).collect()]
    assert got == ["a > c", ""]
    df2 = spark.createDataFrame([(None, "n"), ("p", None), ("p", "n")], "parent string, name string")
    got2 = [r.p for r in df2.select(C.parent_path("parent", "name").alias("p")).collect()]
    assert got2 == [" > n", "p", "p > n"]


def test_rules_stay_in_codegen(spark):
    from layerflow.plans import dims
    raw = spark.read.parquet("/root/testdata/sf0.001/part.parquet").selectExpr(
        *[f"p_name AS {c}" for c in dims.PRODUCT_RAW])
    plan = apply_rules(raw, dims.PRODUCT_RULES, track_rejects=True)._jdf.queryExecution() \
        .executedPlan().toString()
    projects = [ln for ln in plan.splitlines() if "Project" in ln]
    assert projects and all("*" in ln for ln in projects), plan
    assert "ReadSchema: struct<p_name:string>" in plan or "p_name" in plan


def test_run_ts_literal(spark):
    from layerflow.session import RunContext
    from layerflow.sources.files import with_lineage
    run = RunContext("r1", dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc))
    row = with_lineage(_one_col(spark, ["a"]), run, source_name="jdbc:t").first()
    assert row.job_run_id == "r1" and row.source_file_name == "jdbc:t"
    assert row.ingestion_timestamp.replace(tzinfo=None) in (dt.datetime(2024, 1, 2),
                                                            dt.datetime(2024, 1, 2).astimezone().replace(tzinfo=None))
