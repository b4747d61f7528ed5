"""``publish``: APPEND or MERGE a DataFrame into a table and return exact read / inserted / updated
counts; inserted and updated are taken from the written rows themselves (one ``Observation``).

MERGE has one form (see :mod:`layerflow.operators.upsert`).  Its plan reads the source more than once
(keys for the count, rows for each join), so a source is first staged in the shared folder; that also
cuts its lineage, so a lost executor never recomputes the upstream plan.  ``narrow`` sources (scans and
projections) are cheap to read again and are merged straight from their plan.

On a partitioned target only the partitions that a merge can change are read and rewritten.  On a table
format with row-level operations the merge goes through ``DataFrame.mergeInto``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.operators import tables as tb
from layerflow.operators import upsert as up
from layerflow.operators.dedup import Order, comes_before
from layerflow.session import scratch_schema

APPEND, MERGE = "APPEND", "MERGE"
# Providers whose files are rewritten here; others have row-level operations of their own.
FILE_PROVIDERS = ("parquet", "orc", "json", "csv", "text", "hive")


@dataclass
class WriteResult:
    records_read: int = 0
    records_inserted: int = 0
    records_updated: int = 0
    records_rejected: int = 0
    strategy: str = ""

    def counts(self) -> dict[str, int]:
        d = asdict(self)
        d.pop("strategy")
        return d


class MergeCardinalityError(ValueError):
    """More than one source row for a target row (MERGE would be ambiguous)."""


@dataclass
class Staged:
    """Rows written once to the shared folder and registered as a table."""
    table: str
    rows: int
    metrics: dict

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def drop(self, spark: SparkSession) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {self.table}")   # managed: its files go too


def stage(spark: SparkSession, df: DataFrame, near: str, metrics: Sequence = ()) -> Staged:
    """Write ``df`` as a managed table of the scratch schema (in the shared folder).  ``metrics`` are
    extra aggregates observed on the same pass."""
    obs = Observation()
    # observed in the final stage: counted once per partition even on retries
    observed = df.observe(obs, F.count(F.lit(1)).alias("_rows"), *metrics)
    tag = near.replace(".", "_")[-40:]
    name = f"{scratch_schema(spark)}.lf_stage_{tag}_{uuid.uuid4().hex[:12]}"
    observed.write.format("parquet").mode("errorifexists").saveAsTable(name)
    m = dict(obs.get)
    return Staged(name, int(m.pop("_rows")), m)


def publish(spark: SparkSession, df: DataFrame, table: str, load_type: str,
            merge_keys: str | Sequence[str] | None = None, *,
            root: str | None = None, schema: T.StructType | None = None,
            staged: Staged | None = None, narrow: bool = False, buckets: int = 0,
            partition_by: Sequence[str] = (), provider: str = "parquet",
            newer_by: Order | None = None, range_rows: int = 0) -> WriteResult:
    """Write ``df`` into ``table``.

    APPEND adds the rows (inserted = read).  MERGE upserts on ``merge_keys``.  A missing table is created
    from ``schema`` (else the DataFrame's) below ``root``, bucketed into ``buckets`` on the merge keys
    when given, and filled (inserted = read).  ``staged``: ``df`` was already staged by :func:`stage`.
    ``narrow``: ``df`` is cheap to evaluate again and is not staged.  ``newer_by``: a conditional MERGE:
    the newest source row of a key under this order, and it replaces the target's only where it is newer.  ``range_rows``: a new MERGE target is clustered by ranges of
    about that many rows of its first key (:mod:`layerflow.operators.ranged`); merges into it rewrite
    only the ranges they touch."""
    kind = (load_type or "").upper()
    if kind not in (APPEND, MERGE):
        raise ValueError(f"Unknown load_type {load_type!r} for {table}")
    keys = up.parse_keys(merge_keys) if kind == MERGE else None
    if newer_by and kind != MERGE:
        raise ValueError(f"newer_by is for MERGE, not {kind}")

    from layerflow.operators import ranged   # built on this module

    if kind == MERGE and range_rows and not spark.catalog.tableExists(table):
        if root is None or partition_by or buckets:
            raise ValueError(f"{table}: ranges need a root folder and neither partitions nor buckets")
        ranged.create_ranged(spark, table, schema or df.schema, keys[0], root, range_rows)
    if ranged.is_ranged(spark, table):
        if kind == APPEND:
            raise ValueError(f"{table} is clustered by ranges of a merge key: MERGE into it")
        return ranged.merge_ranged(spark, df, table, keys, newer_by)
    if not spark.catalog.tableExists(table):
        if root is None:
            raise ValueError(f"{table} does not exist and no root folder was given")
        schema = schema or df.schema
        bucket_by = keys if (buckets and keys) else ()
        if bucket_by:  # bucket keys are merge keys: declare them NOT NULL
            schema = T.StructType([T.StructField(f.name, f.dataType, f.nullable and f.name not in keys,
                                                 f.metadata) for f in schema.fields])
        tb.create_table(spark, table, schema, root, partition_by=partition_by, bucket_by=bucket_by,
                        buckets=buckets if bucket_by else 0, provider=provider)
        if newer_by:
            return merge_into(spark, df, table, keys, staged=staged, narrow=narrow, newer_by=newer_by)
        n = tb.append_rows(spark, table, df)
        return WriteResult(n, n, 0, strategy="create")
    if kind == APPEND:
        n = tb.append_rows(spark, table, df)
        return WriteResult(n, n, 0, strategy="append")
    return merge_into(spark, df, table, keys, staged=staged, narrow=narrow, newer_by=newer_by)


def touched_partitions(target: DataFrame, src: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """The partitions a merge can change: the source's, and, unless the partition columns are keys,
    those of the target rows with a key of the source."""
    own = src.select(*parts)
    if not set(parts) <= set(keys):
        hit = target.select(*dict.fromkeys([*keys, *parts])).join(src.select(*keys), list(keys), "left_semi")
        own = own.unionByName(hit.select(*parts))
    return tb.touched_table(own, parts)


def merge_into(spark: SparkSession, df: DataFrame, table: str, keys: Sequence[str], *,
               staged: Staged | None = None, narrow: bool = False, newer_by: Order | None = None) -> WriteResult:
    """Upsert ``df`` into the existing ``table`` (see module doc)."""
    keys, target, info = list(keys), spark.table(table), tb.describe(spark, table)
    parts = list(info.partitions)
    src = up.align_to(staged.frame(spark) if staged is not None else df, target.schema)
    src = tb.enforce_not_null(tb.stored_partitions(src, parts), info.not_null, table)
    own = []
    if staged is None and not narrow:
        own.append(stage(spark, src, table))
        src = own[0].frame(spark)
    try:
        read, repeated = up.source_profile(src, keys)
        if newer_by:
            src = up.newest_per_key(src, keys, newer_by)
        elif repeated and up.ambiguous_keys(target, src, keys).limit(1).count():
            raise MergeCardinalityError(f"more than one source row for a target row with keys {keys} in {table}")
        if info.provider not in FILE_PROVIDERS:
            return _merge_by_format(target, src, table, keys, read, newer_by)
        obs, metrics = Observation(), up.merge_metrics_columns()
        if not parts:
            tb.replace_rows(spark, table, up.merged(target, src, keys, newer_by), obs, metrics, [up.OP], info)
            m = obs.get
            return WriteResult(read, int(m["inserted"]), int(m["updated"]), strategy="rewrite")
        own.append(touched := stage(spark, touched_partitions(target, src, keys, parts), table))
        scope = tb.in_partitions(target, touched.frame(spark), parts)
        # rows per touched partition reach the driver as one set of partition values, to find emptied ones
        metrics.append(F.collect_set(F.struct(*parts)).alias("_parts"))
        tb.replace_rows(spark, table, up.merged(scope, src, keys, newer_by), obs, metrics, [up.OP], info)
        m = obs.get
        if not set(parts) <= set(keys):
            drop_emptied(spark, table, touched.frame(spark), parts, m["_parts"])
        return WriteResult(read, int(m["inserted"]), int(m["updated"]), strategy="partitions")
    finally:
        for st in own:
            st.drop(spark)


def drop_emptied(spark: SparkSession, table: str, touched: DataFrame, parts: Sequence[str], written) -> None:
    """Drop the touched partitions that got no row."""
    kept = {tuple(r) for r in written}
    tb.drop_partitions(spark, table, parts, [v for v in touched.select(*parts).collect() if tuple(v) not in kept])


def _merge_by_format(target: DataFrame, src: DataFrame, table: str, keys: Sequence[str], read: int,
                     newer_by: Order | None = None) -> WriteResult:
    """MERGE by the table format itself.  The counts are joins, taken before."""
    cols = target.columns
    s = src.select(*[F.col(c).alias(f"_s_{c}") for c in cols])
    same = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    newer = comes_before(target.schema, keys, newer_by, "_s_") if newer_by else F.lit(True)
    updated = target.join(s, [*same, newer], "left_semi").count()
    inserted = s.join(target.select(*keys), same, "left_anti").count()
    merge = s.mergeInto(table, reduce(lambda a, b: a & b, same))
    row = {c: F.col(f"_s_{c}") for c in cols}
    (merge.whenMatched(newer) if newer_by else merge.whenMatched()).update(row).whenNotMatched().insert(row).merge()
    return WriteResult(read, inserted, updated, strategy="row-level")
