"""Session helpers, the shared scratch folder and the per-run context."""

from __future__ import annotations

import datetime as _dt
import hashlib
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

_OWN_ROOT: dict[int, str] = {}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "layerflow", extra: dict | None = None) -> SparkSession:
    """Session used by tests and the benchmark.  On a cluster, pass no master
    and size ``shuffle_partitions`` to the data (~128-256 MB per partition)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Shared folder for staged data and snapshots.

    Read from ``spark.checkpoint.dir`` (the folder every executor can reach).
    Only in local mode, and only when nothing is configured, a private
    temporary folder is created and registered as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    key = id(spark.sparkContext)
    if key not in _OWN_ROOT:
        _OWN_ROOT[key] = tempfile.mkdtemp(prefix="layerflow-")
        spark.sparkContext.setCheckpointDir(_OWN_ROOT[key])
    return _OWN_ROOT[key]


def scratch_dir(spark: SparkSession, tag: str = "run") -> str:
    """A fresh, never reused folder name below the shared root."""
    base = shared_root(spark)
    return f"{base}/layerflow/{tag}-{uuid.uuid4().hex[:12]}"


def scratch_schema_location(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/layerflow/scratch_db"


def scratch_schema(spark: SparkSession) -> str:
    """Schema for short-lived staging tables, located in the shared folder and named after it: in a
    lasting metastore another folder has another schema.  Its tables are managed, so dropping one also
    removes its files."""
    loc = scratch_schema_location(spark)
    name = "lf_scratch_" + hashlib.sha1(loc.encode()).hexdigest()[:10]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{loc}'")
    return name


def _utc_now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0)


@dataclass(frozen=True)
class RunContext:
    """Values fixed for one run: injected instead of ``current_timestamp()`` so
    a rerun of the same input produces the same rows."""

    job_run_id: str = "manual-run"
    run_ts: _dt.datetime = field(default_factory=_utc_now)
    environment: str = "dev"
    pipeline_name: str = "layerflow"
    executed_by: str | None = None
    workspace_url: str = "unknown"

    def run_ts_naive(self) -> _dt.datetime:
        """``run_ts`` as naive UTC for TIMESTAMP literals (session zone UTC)."""
        ts = self.run_ts
        if ts.tzinfo is not None:
            ts = ts.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return ts
