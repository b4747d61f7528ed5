"""Audit log: one start and one end event per (table, layer, run), appended;
the current state of a run is the latest event for its ``audit_id``.

:func:`start_run` and :func:`end_run` append each event at once.  An :class:`AuditLog` with ``buffered`` keeps the
events of a run and writes them in one append when the run ends, also when it fails, and in between when the
oldest waits longer than ``flush_seconds`` (so a long run shows as RUNNING, and a lost driver loses no more than that).
Its table is partitioned by the day on which an event's run of a layer began, so both events of a layer are in
one partition, and :func:`latest_state` reads the days asked for only."""

from __future__ import annotations

import datetime as _dt
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.operators import tables as tb
from layerflow.operators.dedup import dedup_latest
from layerflow.session import RunContext

# Run states.
RUNNING, SUCCESS, REJECTED, SKIPPED = "RUNNING", "SUCCESS", "REJECTED", "SKIPPED"

_S, _TS, _L = T.StringType(), T.TimestampType(), T.LongType()
# Audit table columns, in declared order.
AUDIT_SCHEMA = T.StructType([
    T.StructField("audit_id", _S, False),
    T.StructField("job_run_id", _S), T.StructField("pipeline_name", _S),
    T.StructField("notebook_name", _S), T.StructField("table_name", _S),
    T.StructField("layer", _S), T.StructField("source_system", _S),
    T.StructField("reporting_unit_id", _S), T.StructField("environment", _S),
    T.StructField("workspace_url", _S), T.StructField("executed_by", _S),
    T.StructField("start_time", _TS), T.StructField("end_time", _TS),
    T.StructField("duration_seconds", T.DoubleType()), T.StructField("status", _S),
    T.StructField("records_read", _L), T.StructField("records_inserted", _L),
    T.StructField("records_updated", _L), T.StructField("records_rejected", _L),
    T.StructField("error_message", _S), T.StructField("created_ts", _TS),
])


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)


@dataclass(frozen=True)
class AuditHandle:
    audit_id: str
    start_time: _dt.datetime
    base: dict


DAY = "audit_date"


def ensure_audit_table(spark: SparkSession, table: str, root: str, by_day: bool = False) -> None:
    schema = T.StructType([*AUDIT_SCHEMA.fields, T.StructField(DAY, T.DateType())]) if by_day else AUDIT_SCHEMA
    tb.create_table(spark, table, schema, root, partition_by=[DAY] if by_day else (),
                    comment="one row per table/layer/run event")


# Appends to one table must not overlap (they share the table's commit
# folder); runs started from several driver threads take turns here.
_APPEND_LOCK = threading.Lock()


def _append(spark: SparkSession, table: str, *rows: dict) -> None:
    # the rows are built from AUDIT_SCHEMA, whose NOT NULL fields createDataFrame
    # verifies, so they go in by position when the table still has that shape
    df = tb.literal_rows(spark, rows, AUDIT_SCHEMA)
    with _APPEND_LOCK:
        columns = spark.table(table).columns
        if DAY in columns:
            df = df.withColumn(DAY, F.to_date("start_time"))
        if columns == df.columns:
            # one file; a single row is one partition as it is, and planned faster
            (df.coalesce(1) if len(rows) > 1 else df).write.mode("append").insertInto(table)
            spark.catalog.refreshTable(table)
        else:
            tb.append_rows(spark, table, df)


def start_run(spark: SparkSession, table: str, run: RunContext, table_id: str, layer,
              source_system: str | None = None, reporting_unit_id: str | None = None,
              notebook_name: str = "run_layer", clock=_now) -> AuditHandle:
    """Append the RUNNING event; counters start at 0."""
    handle, row = _start(run, table_id, layer, source_system, reporting_unit_id, notebook_name, clock())
    _append(spark, table, row)
    return handle


def _start(run: RunContext, table_id: str, layer, source_system, reporting_unit_id, notebook_name: str,
           start: _dt.datetime) -> tuple[AuditHandle, dict]:
    base = {
        "audit_id": str(uuid.uuid4()), "job_run_id": run.job_run_id,
        "pipeline_name": run.pipeline_name, "notebook_name": notebook_name,
        "table_name": table_id, "layer": str(layer), "source_system": source_system,
        "reporting_unit_id": reporting_unit_id, "environment": run.environment,
        "workspace_url": run.workspace_url, "executed_by": run.executed_by,
        "start_time": start,
    }
    return AuditHandle(base["audit_id"], start, base), dict(
        base, status=RUNNING, records_read=0, records_inserted=0, records_updated=0, records_rejected=0, created_ts=start)


def end_run(spark: SparkSession, table: str, handle: AuditHandle, status: str,
            records_read: int = 0, records_inserted: int = 0, records_updated: int = 0,
            records_rejected: int = 0, error_message: str | None = None, clock=_now) -> None:
    """Append the final event; the error text is stored as given."""
    _append(spark, table, _end(handle, status, clock(), records_read=records_read, records_inserted=records_inserted,
                               records_updated=records_updated, records_rejected=records_rejected,
                               error_message=error_message))


def _end(handle: AuditHandle, status: str, end: _dt.datetime, **fields) -> dict:
    counts = dict.fromkeys(("records_read", "records_inserted", "records_updated", "records_rejected"), 0)
    return {**handle.base, **counts, **fields, "status": status, "end_time": end, "created_ts": end,
            "duration_seconds": (end - handle.start_time).total_seconds()}


class AuditLog:
    """The events of a pipeline's runs, written at once or buffered; used by several threads."""

    def __init__(self, spark: SparkSession, table: str, run: RunContext, buffered: bool = False,
                 flush_seconds: float = 300, clock=_now):
        self.spark, self.table, self.run, self.clock = spark, table, run, clock
        self.buffered, self.flush_seconds = buffered, flush_seconds
        self._rows: list[dict] = []
        self._open, self._lock = 0, threading.RLock()

    def start(self, table_id: str, layer, source_system: str | None = None,
              reporting_unit_id: str | None = None, notebook_name: str = "run_layer") -> AuditHandle:
        handle, row = _start(self.run, table_id, layer, source_system, reporting_unit_id, notebook_name, self.clock())
        self._add(row)
        return handle

    def end(self, handle: AuditHandle, status: str, **fields) -> None:
        self._add(_end(handle, status, self.clock(), **fields))

    def _add(self, row: dict) -> None:
        with self._lock:
            self._rows.append(row)
            waits = (self.clock() - self._rows[0]["created_ts"]).total_seconds()
            if not (self.buffered and self._open) or waits > self.flush_seconds:
                self.flush()

    def flush(self) -> None:
        """Write what is buffered.  Rows leave the buffer only when they are written."""
        with self._lock:
            if self._rows:
                _append(self.spark, self.table, *self._rows)
                self._rows = []

    @contextmanager
    def run_of(self) -> Iterator[None]:
        """A run, whose events are written when it ends or fails; runs inside are part of it."""
        with self._lock:
            self._open += 1
        try:
            yield
        finally:
            with self._lock:
                self._open -= 1
                if not self._open:
                    self.flush()


def latest_state(events: DataFrame, first_day: _dt.date | None = None, last_day: _dt.date | None = None) -> DataFrame:
    """One row per ``audit_id``: the final event when present, else the start.  With days, of the layers that
    began on them; a log by day is read in these partitions only."""
    if first_day or last_day:
        day = F.col(DAY) if DAY in events.columns else F.to_date("start_time")
        for bound, kept in ((first_day, day >= F.lit(first_day)), (last_day, day <= F.lit(last_day))):
            events = events.where(kept) if bound else events
    return (dedup_latest(events.withColumn("_final", F.col("end_time").isNotNull()),
                         ["audit_id"], [("_final", "desc"), ("created_ts", "desc")])
            .drop("_final"))


def compact(spark: SparkSession, table: str) -> None:
    """Rewrite the many one-row files of an audit log into few files: a ``REBALANCE`` lets AQE size
    them to its advisory partition size.  Maintenance, not part of a run: no driver may append to the
    log meanwhile, because its events would stay in the replaced snapshot."""
    with _APPEND_LOCK:
        tb.replace_rows(spark, table, spark.table(table).hint("rebalance"))
