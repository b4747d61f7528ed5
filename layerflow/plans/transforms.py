"""The per-layer steps as DataFrame -> DataFrame functions.

``land``    CSV (or JDBC) rows as strings plus lineage columns
``curate``  rules (rename/trim/cast/flag) -> latest row per key -> load columns
``enrich``  derived gold columns -> gold column order
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.functions.rules import REJECT_COLUMN, ColumnRule, apply_rules, failed_targets
from layerflow.operators.dedup import dedup_latest
from layerflow.session import RunContext
from layerflow.sources.files import RAW_LINE, read_csv_strings, with_lineage

INGESTED = "ingestion_timestamp"
MALFORMED_SCHEMA = T.StructType([
    T.StructField("source_file_name", T.StringType()), T.StructField("raw_line", T.StringType()),
    T.StructField("rejected_load_timestamp", T.TimestampType()), T.StructField("job_run_id", T.StringType())])


def land(spark: SparkSession, path: str | list[str], run: RunContext,
         columns: Sequence[str] | None = None, job_run_id: str | None = None) -> DataFrame:
    return with_lineage(read_csv_strings(spark, path, columns), run, job_run_id=job_run_id)


def land_checked(spark: SparkSession, path: str | list[str], run: RunContext,
                 columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, Observation]:
    """(rows, malformed lines, observation of the first): :func:`land` without the records that have too
    few or too many fields, and those records as file, line and run.  The observation's ``malformed`` is
    filled when the rows are written; only if it is not zero need the lines be read."""
    seen, every = Observation(), read_csv_strings(spark, path, columns, malformed=True)
    good = every.observe(seen, F.count_if(F.col(RAW_LINE).isNotNull()).alias("malformed"))
    rows = with_lineage(good.where(F.col(RAW_LINE).isNull()).drop(RAW_LINE), run)
    return rows, malformed_lines(every, run), seen


def malformed_lines(every: DataFrame, run: RunContext) -> DataFrame:
    return every.where(F.col(RAW_LINE).isNotNull()).select(
        F.col("_metadata.file_path").alias("source_file_name"), F.col(RAW_LINE).alias("raw_line"),
        F.lit(run.run_ts).cast("timestamp").alias("rejected_load_timestamp"), F.lit(run.job_run_id).alias("job_run_id"))


def curate(raw: DataFrame, rules: list[ColumnRule], keys: Sequence[str], run: RunContext,
           track_rejects: bool = True, order: Sequence = ((INGESTED, "desc"),)) -> DataFrame:
    """Typed, one row per key: the most recently ingested row wins, ties
    broken by the row's remaining columns.  A value that does not convert is NULL in the published row;
    :func:`rejected` keeps its text."""
    typed = apply_rules(raw, rules, keep=[INGESTED], track_rejects=track_rejects)
    latest = dedup_latest(typed, keys, list(order)).drop(INGESTED)
    out = latest.withColumns({
        "curated_load_timestamp": F.lit(run.run_ts).cast("timestamp"),
        "job_run_id": F.lit(run.job_run_id),
    })
    cols = [r.target for r in rules] + ["curated_load_timestamp", "job_run_id"]
    if track_rejects:
        cols.append(REJECT_COLUMN)
    return out.select(*cols)


def rejected(raw: DataFrame, rules: list[ColumnRule], run: RunContext) -> DataFrame:
    """The rows, before dedup, with a value that did not convert: the raw text of every source column,
    the failed targets and the run.  Rows that landed twice with the same text are one."""
    sources = list(dict.fromkeys(r.source for r in rules if r.source))
    kept = apply_rules(raw, [ColumnRule(c, c, "copy") for c in sources], track_rejects=False, keep=[])
    checked = kept.withColumn("rejected_columns", failed_targets(rules))
    return checked.where(F.col("rejected_columns") != "").distinct().withColumns({
        "rejected_load_timestamp": F.lit(run.run_ts).cast("timestamp"), "job_run_id": F.lit(run.job_run_id)})


def enrich(curated: DataFrame, rules: list[ColumnRule], order: Sequence[str],
           run: RunContext) -> DataFrame:
    out = curated.withColumns({r.target: r.expression() for r in rules})
    out = out.withColumns({"gold_load_timestamp": F.lit(run.run_ts).cast("timestamp"),
                           "job_run_id": F.lit(run.job_run_id)})
    return out.select(*order)
