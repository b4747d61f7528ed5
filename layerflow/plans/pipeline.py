"""Runs: one (table, layer), all layers of a table, or every active table.

A layer's transform is looked up by the name stored in the metadata's
``layerN_script_path`` column in a registry of Python functions (no code is
loaded from paths).  A transform returns a lazy DataFrame; ``publish`` is the
only data action, the audit log gets a start and an end event per run.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.functions.rules import ColumnRule, rules_from_metadata
from layerflow.operators import tables as tb
from layerflow.operators.compaction import AutoCompact, compact_appends
from layerflow.operators.dedup import Order
from layerflow.operators.publish import WriteResult, publish
from layerflow.operators.ranged import expire_ranges, is_ranged
from layerflow.operators.upsert import parse_keys
from layerflow.plans import audit as au
from layerflow.plans import dims, specs
from layerflow.plans.isolation import TableJobs
from layerflow.plans.transforms import MALFORMED_SCHEMA, curate, enrich, land_checked, rejected
from layerflow.session import RunContext
from layerflow.sources.jdbc import read_jdbc
from layerflow.sources.files import LINEAGE_COLUMNS, with_lineage
from layerflow.sources.landed import Landing, begin_landing
from layerflow.streaming.landing import Landed, land_available
from layerflow.sources.tables import (WATERMARK_PROPERTY, encode_watermark, history_of, late_batch, next_batch,
                                      source_batch, stored_watermark)

# The load-time column each layer writes.
LOAD_TS = {0: "ingestion_timestamp", 1: "curated_load_timestamp", 2: "gold_load_timestamp"}


@dataclass
class PipelineConfig:
    metadata_table: str
    audit_table: str
    root: str                      # folder below which new tables get their snapshots
    buckets: int = 0               # >0: MERGE targets bucketed on their keys (Spark's CLUSTERED BY)
    range_rows: int = 0            # >0: unpartitioned MERGE targets clustered by key ranges of so many rows
    provider: str = "parquet"      # table format of new tables; see operators.publish for others
    stream_landing: bool = False   # layer 0 lands only files not landed before
    # after an append, partitions with too many small files are packed
    auto_compact: AutoCompact | None = None
    # audit events of a run are written together, into a log partitioned by day
    buffered_audit: bool = False
    # seconds that one table's run may take; then its jobs are cancelled and the others go on
    table_timeout: float | None = None
    # layer 0 as a batch appends only files not landed before (by path, size and time), also when it is run again
    land_once: bool = False
    # set: after each write, delete the target's unread snapshots older than this
    expire_snapshots_after: float | None = None
    # how far below the stored business watermark a source's late rows are looked for: a number, or "3 days"
    lateness: str | int | float | None = None
    jdbc_url: str | None = None
    jdbc_options: dict = field(default_factory=dict)


@dataclass
class LayerContext:
    spark: SparkSession
    spec: specs.TableSpec
    layer: int
    run: RunContext
    config: PipelineConfig
    # set in incremental mode: (source table, column, new token)
    watermark: tuple[str, str, str] | None = None
    nothing_new: bool = False
    # rows with values that did not convert, or malformed lines, written after the publish
    rejects: DataFrame | None = None
    # set by a file landing: counts the malformed lines on the publish's own pass
    malformed: Observation | None = None
    # set by a file landing with ``land_once``: its files, to be marked after the write
    landing: Landing | None = None

    @property
    def target(self) -> specs.LayerSpec:
        return self.spec.layer(self.layer)

    @property
    def business_watermark(self) -> str | None:
        """The watermark column when it is the source's own, not the library's load time: layer 0 reads
        the source by it, typed.  Later layers always read by load time."""
        wm = self.spec.watermark_column
        return wm if wm and wm not in LOAD_TS.values() else None

    def _stored(self, src: str, col: str) -> str | None:
        tgt = self.target.table_name
        if not self.spark.catalog.tableExists(tgt):
            return None
        return stored_watermark(tb.table_properties(self.spark, tgt), src, col)

    def source_rows(self, df: DataFrame, src: str) -> DataFrame:
        """Layer 0: the rows of a typed source from the stored business watermark on, and, with a lateness
        window, those below it that have not been landed."""
        col = self.business_watermark
        if col is None:
            return df
        last = self._stored(src, col)
        if last is not None and self.config.lateness is not None:
            landed = self.spark.table(self.target.table_name)
            batch, token = late_batch(df, landed, col, last, self.config.lateness)
        else:
            batch, token = source_batch(df, col, last)
        if token is not None:
            self.watermark = (src, col, token)
        return batch

    def _batch(self) -> tuple[DataFrame, DataFrame]:
        """(rows not read before, all rows so far) of the previous layer's table.  Without a watermark
        column in the metadata both are the whole table; with one, the rows whose load time is after
        the one stored on the target by the last successful run, up to the current maximum (recorded
        here, stored after the write)."""
        src = self.spec.layer(self.layer - 1).table_name
        df = self.spark.table(src)
        if not self.spec.watermark_column:
            return df, df
        col = LOAD_TS[self.layer - 1]
        if col not in df.columns:
            raise ValueError(f"{self.spec.table_id}: {src} has no load time {col!r}")
        batch, token = next_batch(df, col, self._stored(src, col))
        if token is None:
            self.nothing_new = True
        else:
            self.watermark = (src, col, token)
        return batch, df

    def upstream(self, keys: dict[str, Column] | None = None) -> DataFrame:
        """The previous layer's rows to transform.  A transform that picks one row per key by an order of
        its own is registered with ``newer_by`` and needs no more than this: the MERGE compares with the
        row in the target.  ``keys`` (name -> expression over that layer): in incremental mode, all rows so
        far of the keys that have new ones, for transforms that need more of the history (a sum, the first
        row); that scans the whole previous layer."""
        batch, every = self._batch()
        return history_of(batch, every, keys) if keys and batch is not every else batch

    def upstream_by_rules(self, rules: list[ColumnRule]) -> DataFrame:
        """The rows for a curation by ``rules`` with the latest landed row per key; the new rows whose
        values do not convert are kept for the reject table.

        In incremental mode these are the batch alone: every row of it was landed after every row of the
        batches before (its lower bound is the highest load time read so far), so its latest row of a
        key is the latest of all, and the MERGE puts it in place of the curated one.  No history is read."""
        batch, _ = self._batch()
        self.rejects = rejected(batch, rules, self.run)
        return batch


@dataclass(frozen=True)
class Transform:
    fn: Callable[[LayerContext], DataFrame]
    schema: Callable[[LayerContext], T.StructType | None] = lambda ctx: None
    # narrow: scans and projections only; cheap to recompute, so a merge
    # need not stage it first
    narrow: bool = False
    # order columns of the target: its MERGE is conditional, a row is only replaced by a newer one
    newer_by: Order | None = None


TRANSFORMS: dict[str, Transform] = {}


def register(name: str, schema: Callable[[LayerContext], T.StructType | None] | None = None,
             narrow: bool = False, newer_by: Order | None = None):
    """Decorator: make ``fn(ctx) -> DataFrame`` runnable under ``name``."""
    def deco(fn):
        TRANSFORMS[name] = Transform(fn, schema or (lambda ctx: None), narrow, newer_by)
        return fn
    return deco


def land_source(ctx: LayerContext, columns=None) -> DataFrame:
    """Layer 0: the rows of the table's source, all columns as text, with lineage; of files, without the
    malformed lines, which become the run's rejects."""
    spec = ctx.spec
    if (spec.source_system or "FILE").upper() == "FILE":
        if ctx.business_watermark:
            raise ValueError(f"{spec.table_id}: watermark {spec.watermark_column!r} is text in a file source; "
                             f"use {LOAD_TS[0]}")
        path = spec.source_table
        if ctx.config.land_once:
            if "." in ctx.target.table_name:
                tb.create_schema(ctx.spark, ctx.target.table_name.rsplit(".", 1)[0])
            ctx.landing = begin_landing(ctx.spark, path, ctx.target.table_name, ctx.target.table_name + "_landed",
                                        f"{ctx.config.root}/_landed/{ctx.target.table_name.replace('.', '/')}", ctx.run,
                                        lambda files: _rows_by_file(ctx, files, columns))
            path = ctx.landing.files
            if not path:
                ctx.nothing_new = True
                return ctx.spark.createDataFrame([], "none string")
        rows, ctx.rejects, ctx.malformed = land_checked(ctx.spark, path, ctx.run, columns)
        return rows
    if not ctx.config.jdbc_url:
        raise ValueError(f"{spec.table_id}: source {spec.source_system} needs a jdbc_url")
    table = ".".join(p for p in (spec.source_schema, spec.source_table) if p)
    df = read_jdbc(ctx.spark, ctx.config.jdbc_url, table, **ctx.config.jdbc_options)
    df = ctx.source_rows(df, table)
    df = df.select(*[F.col(c).cast("string").alias(c) for c in (columns or df.columns)])
    return with_lineage(df, ctx.run, source_name=f"{spec.source_system}:{table}")


def _rows_by_file(ctx: LayerContext, files: list[str], columns) -> DataFrame:
    rows, _, _ = land_checked(ctx.spark, files, ctx.run, columns)
    return rows.groupBy(F.col(LINEAGE_COLUMNS[0]).alias("file")).agg(F.count(F.lit(1)).alias("n"))


def _register_dimension(d: dims.Dimension) -> None:
    register(f"{d.name}.l0", lambda ctx: d.raw_schema)(lambda ctx: land_source(ctx, d.raw))
    register(f"{d.name}.l1", lambda ctx: d.curated_schema)(
        lambda ctx: curate(ctx.upstream_by_rules(d.rules), d.rules, [d.key], ctx.run, track_rejects=False))
    register(f"{d.name}.l2", lambda ctx: d.gold_schema, narrow=True)(
        lambda ctx: enrich(ctx.upstream(), d.gold_rules, d.gold_order, ctx.run))


for _d in dims.DIMENSIONS.values():
    _register_dimension(_d)


@register("land_csv")
def _land_generic(ctx: LayerContext) -> DataFrame:
    return land_source(ctx)


@register("curate_rules")
def _curate_generic(ctx: LayerContext) -> DataFrame:
    """Layer 1 from metadata: column mapping + transformation rules."""
    t = ctx.target
    rules, keys = rules_from_metadata(t.column_mapping, t.transformation_rules), parse_keys(t.merge_keys)
    return curate(ctx.upstream_by_rules(rules), rules, keys, ctx.run, track_rejects=False)


@register("gold_rules", narrow=True)
def _gold_generic(ctx: LayerContext) -> DataFrame:
    """Layer 2 from metadata: the curated columns plus rule outputs."""
    t = ctx.target
    src = ctx.upstream().drop("curated_load_timestamp")
    rules = rules_from_metadata(t.column_mapping, t.transformation_rules)
    order = [c for c in src.columns if c != "job_run_id"] + [r.target for r in rules]
    return enrich(src, rules, order + ["gold_load_timestamp", "job_run_id"], ctx.run)


class RunFailed(RuntimeError):
    """Some tables of a run failed; ``errors`` and ``status`` are by table id."""

    def __init__(self, errors: dict[str, Exception], status: dict[str, str]):
        super().__init__("failed: " + "; ".join(f"{t}: {e}" for t, e in sorted(errors.items())))
        self.errors, self.status = errors, status


class Pipeline:
    def __init__(self, spark: SparkSession, config: PipelineConfig, run: RunContext):
        if run.executed_by is None:
            # the session's user, as Spark SQL's current_user() reports it
            run = dataclasses.replace(run, executed_by=spark.sql("SELECT current_user()").first()[0])
        self.spark, self.config, self.run = spark, config, run
        au.ensure_audit_table(spark, config.audit_table, f"{config.root}/_audit", by_day=config.buffered_audit)
        self.audit = au.AuditLog(spark, config.audit_table, run, config.buffered_audit)

    def metadata(self) -> DataFrame:
        return self.spark.table(self.config.metadata_table)

    def _table_root(self, name: str) -> str:
        return f"{self.config.root}/{name.replace('.', '/')}"

    def _write(self, ctx: LayerContext, df: DataFrame, schema, narrow: bool = False,
               newer_by: Order | None = None) -> WriteResult:
        spark, cfg, t = self.spark, self.config, ctx.target
        name = t.table_name
        load_type = t.load_type or ("APPEND" if ctx.layer == 0 else "MERGE")
        keys = parse_keys(t.merge_keys) if ctx.layer != 0 and load_type.upper() == "MERGE" else None
        if "." in name:
            tb.create_schema(spark, name.rsplit(".", 1)[0])
        # the metadata's partition column applies to the layers that have it
        pc = ctx.spec.partition_column
        parts = [pc] if pc and pc in df.columns else []
        res = publish(spark, df, name, load_type, keys, root=self._table_root(name), schema=schema,
                      narrow=narrow, buckets=cfg.buckets if keys else 0, partition_by=parts, provider=cfg.provider,
                      newer_by=newer_by, range_rows=0 if parts or not keys else cfg.range_rows)
        if ctx.rejects is not None:
            rows, rejects = ctx.rejects, name + "_rejects"
            if ctx.malformed is not None and not ctx.malformed.get["malformed"]:
                if not spark.catalog.tableExists(rejects):
                    return res
                rows = spark.createDataFrame([], rows.schema)   # the drop is not read again
            res.records_rejected = self._write_rejects(rows, rejects)
            if ctx.malformed is not None:
                res.records_read += res.records_rejected
        return res

    def _compact(self, name: str) -> None:
        if self.config.auto_compact is not None:
            compact_appends(self.spark, name, self.config.auto_compact)

    def _write_rejects(self, rows: DataFrame, name: str) -> int:
        """Replace this run's rows of the reject table (partitioned by run), after the publish: a
        failed run leaves none, a repeated one leaves one set."""
        spark, run_id = self.spark, self.run.job_run_id
        tb.create_table(spark, name, rows.schema, self._table_root(name), partition_by=["job_run_id"])
        obs = Observation()
        tb.replace_rows(spark, name, rows, obs, [F.count(F.lit(1)).alias("n")])
        n = int(obs.get["n"])
        if not n:
            old = spark.sql(f"SHOW PARTITIONS {tb.check_name(name)} PARTITION (job_run_id = {tb.sql_string(run_id)})")
            if old.count():
                tb.drop_partitions(spark, name, ["job_run_id"], [{"job_run_id": run_id}])
        return n

    def run_layer(self, table_id: str, layer: int, spec: specs.TableSpec | None = None,
                  jobs: TableJobs | None = None) -> str:
        """One (table, layer); ``spec``: the table's metadata when the caller
        already looked it up; ``jobs``: the isolation of the table's run."""
        spec = spec or specs.lookup(self.metadata(), table_id)
        ls = spec.layer(layer)
        if not ls.is_active:
            h = self.audit.start(table_id, layer, spec.source_system, spec.reporting_unit_id)
            self.audit.end(h, au.SKIPPED)
            return au.SKIPPED
        h = self.audit.start(table_id, layer, spec.source_system, spec.reporting_unit_id)
        try:
            with jobs.limited() if jobs is not None else nullcontext():
                res = self._transform_or_land(spec, layer)
        except Exception as e:
            self.audit.end(h, au.REJECTED, error_message=str(e))
            raise
        self.audit.end(h, au.SUCCESS, **res.counts())
        return au.SUCCESS

    def _transform_or_land(self, spec: specs.TableSpec, layer: int) -> WriteResult:
        ls = spec.layer(layer)
        tr = TRANSFORMS.get(ls.script_path or "")
        if tr is None:
            raise LookupError(f"no transform registered as {ls.script_path!r}")
        ctx = LayerContext(self.spark, spec, int(layer), self.run, self.config)
        self._check_run_after_downstream(ctx)
        if self._streams(ctx):
            return self._land_new_files(ctx, tr.schema(ctx))
        return self._transform_and_write(ctx, tr)

    def _transform_and_write(self, ctx: LayerContext, tr: Transform) -> WriteResult:
        df = tr.fn(ctx)
        if ctx.nothing_new:
            return WriteResult(strategy="no-new-rows")   # the target is not rewritten
        res = self._write(ctx, df, tr.schema(ctx), tr.narrow, tr.newer_by)
        if ctx.landing is not None:
            ctx.landing.commit()
        if res.strategy == "append":
            self._compact(ctx.target.table_name)
        if ctx.watermark:
            # after the snapshot switch: a failed run leaves the old
            # watermark, and the rerun reads the same rows again
            tb.set_properties(self.spark, ctx.target.table_name,
                              {WATERMARK_PROPERTY: encode_watermark(*ctx.watermark)})
        if self.config.expire_snapshots_after is not None:
            expire = expire_ranges if is_ranged(self.spark, ctx.target.table_name) else tb.expire_snapshots
            expire(self.spark, ctx.target.table_name, self.config.expire_snapshots_after)
        return res

    def _streams(self, ctx: LayerContext) -> bool:
        return (ctx.layer == 0 and self.config.stream_landing
                and (ctx.spec.source_system or "FILE").upper() == "FILE")

    def _land_new_files(self, ctx: LayerContext, schema) -> WriteResult:
        """Layer 0 as an ``availableNow`` stream over the drop folder: the
        files already landed are listed in a checkpoint in the shared folder,
        so a run reads only new files."""
        spark, name = self.spark, ctx.target.table_name
        if schema is None:
            raise ValueError(f"{ctx.spec.table_id}: stream landing needs a declared raw schema")
        if "." in name:
            tb.create_schema(spark, name.rsplit(".", 1)[0])
        pc = ctx.spec.partition_column
        parts = [pc] if pc and pc in schema.names else []
        tb.create_table(spark, name, schema, self._table_root(name), partition_by=parts)
        folder = ctx.spec.source_table
        ckpt = (f"{self.config.root}/_landing/{name.replace('.', '/')}/"
                f"{hashlib.sha1(folder.encode()).hexdigest()[:12]}")
        cols = [f.name for f in schema.fields if f.name not in LINEAGE_COLUMNS]
        rejects, rejected = name + "_rejects", Landed()
        tb.create_table(spark, rejects, MALFORMED_SCHEMA, self._table_root(rejects), partition_by=["job_run_id"])
        n = land_available(spark, folder, cols, name, ctx.run, checkpoint=ckpt, rejects=rejects, rejected=rejected)
        if n:
            self._compact(name)
        return WriteResult(n + rejected.rows, n, 0, rejected.rows, strategy="new-files")

    def _check_run_after_downstream(self, ctx: LayerContext) -> None:
        """In incremental mode the next layer skips rows at or below its
        watermark.  Rows this run writes carry ``run_ts`` as load time, so a
        run not later than that watermark would write rows nobody reads:
        refuse it instead of losing them."""
        nxt = ctx.layer + 1
        if not ctx.spec.watermark_column or nxt not in ctx.spec.layers:
            return
        col = LOAD_TS[ctx.layer]
        down = ctx.spec.layer(nxt).table_name
        if not down or not self.spark.catalog.tableExists(down):
            return
        token = stored_watermark(tb.table_properties(self.spark, down),
                                 ctx.target.table_name, col)
        ts = ctx.run.run_ts_naive().replace(tzinfo=_dt.timezone.utc)
        micros = int(ts.timestamp()) * 1_000_000 + ts.microsecond
        if token is not None and token.lstrip("-").isdigit() and int(token) >= micros:
            raise ValueError(f"{ctx.spec.table_id}: run time {ts} is not after the watermark "
                             f"of {down}; its rows would never be read downstream")

    def run_table(self, table_id: str, layers=specs.LAYERS) -> str:
        """Layers in order; stop at the first SKIPPED; errors propagate, and each is in the audit log,
        a failed metadata lookup too (under the first layer).  The table's jobs are in a pool and under a
        tag of their own; past ``table_timeout`` they are cancelled and the layer is audited REJECTED."""
        with self.audit.run_of(), TableJobs(self.spark, table_id, self.config.table_timeout) as jobs:
            return self._run_table(table_id, layers, jobs)

    def _run_table(self, table_id: str, layers, jobs: TableJobs) -> str:
        status = au.SUCCESS
        try:
            spec = specs.lookup(self.metadata(), table_id)     # one lookup for all layers
        except Exception as e:
            h = self.audit.start(table_id, layers[0])
            self.audit.end(h, au.REJECTED, error_message=str(e))
            raise
        for layer in layers:
            status = self.run_layer(table_id, layer, spec, jobs)
            if status == au.SKIPPED:
                break
            if status != au.SUCCESS:
                raise RuntimeError(f"unexpected status {status} for {table_id} layer {layer}")
        return status

    def run_active(self, table_group: str | None = None, max_parallel: int = 1) -> dict[str, str]:
        """Every active table; up to ``max_parallel`` tables run at once as concurrent Spark jobs from
        driver threads.  A failing table does not stop the others; when all are done, one
        :class:`RunFailed` names those that failed."""
        ids = list(dict.fromkeys(specs.active_ids(self.metadata(), table_group)))
        failed: dict[str, Exception] = {}

        def one(tid):
            try:
                return tid, self.run_table(tid)
            except Exception as e:
                failed[tid] = e
                return tid, au.REJECTED

        with self.audit.run_of(), ThreadPoolExecutor(max_workers=max(1, max_parallel)) as ex:
            status = dict(ex.map(one, ids))
        if failed:
            raise RunFailed(failed, status)
        return status
