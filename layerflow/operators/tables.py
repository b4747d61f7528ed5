"""Catalog tables on Parquet files.

Without a row-level table format Spark cannot overwrite a plain table that it reads, so a rewrite
(upsert, update, backfill) of an unpartitioned table writes a new snapshot directory next to the current
one and then switches the table with ``ALTER TABLE ... SET LOCATION``: one metastore call, so readers
see the old or the new snapshot.  A failed or killed job leaves only an unreferenced directory behind.

A partitioned table is rewritten by Spark's own dynamic partition overwrite: only the partitions that
the rewrite touches are read and replaced, at the job's commit, one after the other.  A reader during
that commit may see some partitions replaced and others not yet; a driver lost during it can leave that
state, which running the same rewrite again repairs.  A bucketed table is overwritten by Spark's own
``INSERT OVERWRITE`` from the staged result, with the same caveat.

Appends go through Spark's commit protocol.  One writer per table at a time is assumed; old snapshots
are left for :func:`expire_snapshots`.  Spark stores an empty string in a string partition column as
NULL; so do the functions here, before anything is compared.
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_NULL_PROPERTY = "layerflow.not_null"

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}$")


def check_name(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"bad table name {name!r}")
    return name


def sql_string(text: str) -> str:
    """Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_schema(spark: SparkSession, name: str, comment: str | None = None,
                  location: str | None = None) -> None:
    check_name(name)
    sql = f"CREATE SCHEMA IF NOT EXISTS {name}"
    if comment:
        sql += f" COMMENT {sql_string(comment)}"
    if location:
        sql += f" LOCATION {sql_string(location)}"
    spark.sql(sql)


def ddl_columns(schema: T.StructType, comments: dict[str, str] | None = None) -> str:
    comments = comments or {}
    parts = []
    for f in schema.fields:
        s = f"`{f.name}` {f.dataType.simpleString()}"
        if not f.nullable:
            s += " NOT NULL"
        if f.name in comments:
            s += f" COMMENT {sql_string(comments[f.name])}"
        parts.append(s)
    return ", ".join(parts)


def new_snapshot_location(root: str) -> str:
    return f"{root.rstrip('/')}/snap-{uuid.uuid4().hex[:16]}"


def create_table(spark: SparkSession, name: str, schema: T.StructType, root: str,
                 comment: str | None = None, partition_by: Sequence[str] = (),
                 column_comments: dict[str, str] | None = None,
                 properties: dict[str, str] | None = None,
                 bucket_by: Sequence[str] = (), buckets: int = 0, provider: str = "parquet") -> bool:
    """CREATE TABLE IF NOT EXISTS over a first, empty snapshot below ``root``.
    Returns True when the table was created.

    Parquet tables drop NOT NULL from the schema, so the declared NOT NULL
    columns are kept in a table property and enforced by every write.

    ``bucket_by``/``buckets`` are Spark's own ``CLUSTERED BY``.  Bucket columns must be NOT NULL: NULL
    keys would all share one bucket.  ``provider``: another table format of the session's catalog;
    MERGE and UPDATE then go through the format itself."""
    check_name(name)
    if spark.catalog.tableExists(name):
        return False
    required = [f.name for f in schema.fields if not f.nullable]
    if bucket_by:
        if buckets <= 0:
            raise ValueError("bucketed table needs buckets > 0")
        nullable = [c for c in bucket_by if c not in required]
        if nullable:
            raise ValueError(f"bucket columns must be NOT NULL: {nullable}")
    loc = new_snapshot_location(root)
    if provider == "parquet" and not bucket_by:
        empty = spark.createDataFrame([], schema)
        (empty.write.partitionBy(*partition_by) if partition_by else empty.write).parquet(loc)
    properties = dict(properties or {})
    if required:
        properties[NOT_NULL_PROPERTY] = ",".join(required)
    sql = f"CREATE TABLE {name} ({ddl_columns(schema, column_comments)}) USING {check_name(provider)}"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    if bucket_by:
        cols = ", ".join(f"`{c}`" for c in bucket_by)
        sql += f" CLUSTERED BY ({cols}) SORTED BY ({cols}) INTO {int(buckets)} BUCKETS"
    sql += f" LOCATION {sql_string(loc)}"
    if comment:
        sql += f" COMMENT {sql_string(comment)}"
    if properties:
        props = ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in properties.items())
        sql += f" TBLPROPERTIES ({props})"
    spark.sql(sql)
    if provider == "parquet" and bucket_by:
        # by the table: a file of no bucket would fail every scan by buckets
        spark.createDataFrame([], spark.table(name).schema).write.insertInto(name)
    return True


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {check_name(name)}")


def table_info(spark: SparkSession, name: str) -> dict[str, str]:
    """``DESCRIBE TABLE EXTENDED`` detail rows (metadata only)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {check_name(name)}").collect()
    out, detail = {}, False
    for r in rows:
        if r.col_name.startswith("# Detailed Table Information"):
            detail = True
            continue
        if detail and r.col_name:
            out[r.col_name] = r.data_type
    return out


@dataclass(frozen=True)
class TableInfo:
    """What a write needs to know of a table, from one catalog lookup."""
    provider: str
    location: str
    partitions: tuple[str, ...]
    buckets: int
    properties: dict[str, str]

    @property
    def not_null(self) -> list[str]:
        return [c for c in self.properties.get(NOT_NULL_PROPERTY, "").split(",") if c]


def describe(spark: SparkSession, name: str) -> TableInfo:
    d = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {check_name(name)} AS JSON").first()[0])
    return TableInfo(d.get("provider", "parquet").lower(), d.get("location", ""), tuple(d.get("partition_columns", ())),
                     int(d.get("num_buckets") or 0), dict(d.get("table_properties", {})))


def table_location(spark: SparkSession, name: str) -> str:
    return table_info(spark, name)["Location"]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    rows = spark.sql(f"DESCRIBE TABLE {check_name(name)}").collect()
    out, part = [], False
    for r in rows:
        if r.col_name == "# Partition Information":
            part = True
        elif part and r.col_name and not r.col_name.startswith("#"):
            out.append(r.col_name)
    return out


def provider_of(spark: SparkSession, name: str) -> str:
    return table_info(spark, name).get("Provider", "parquet").lower()


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {check_name(name)}").collect()}


def set_properties(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    props = ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in properties.items())
    try:
        spark.sql(f"ALTER TABLE {check_name(name)} SET TBLPROPERTIES ({props})")
    except AnalysisException as e:
        if not (e.getCondition() or "").startswith("EXPECT_TABLE_NOT_VIEW"):
            raise
        spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ({props})")


def not_null_columns(spark: SparkSession, name: str) -> list[str]:
    value = table_properties(spark, name).get(NOT_NULL_PROPERTY, "")
    return [c for c in value.split(",") if c]


def enforce_not_null(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Fail the write (inside the tasks, before any commit) on a NULL in a
    NOT NULL column.  Parquet tables accept the DDL but would store NULLs."""
    if not columns:
        return df
    return df.withColumns({
        c: F.when(F.col(c).isNull(),
                  F.raise_error(F.lit(f"NULL in NOT NULL column {c} of {table}")))
            .otherwise(F.col(c))
        for c in columns
    })


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, cast to its types (extra ones dropped)."""
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"missing columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def append_rows(spark: SparkSession, name: str, df: DataFrame) -> int:
    """Append by column name into the current snapshot; returns the rows written."""
    info, obs = describe(spark, name), Observation()
    out = enforce_not_null(aligned(df, spark.table(name).schema), info.not_null, name)
    out = clustered_for_write(out, info.partitions).observe(obs, F.count(F.lit(1)).alias("n"))
    out.write.mode("append").insertInto(name)
    spark.catalog.refreshTable(name)
    return int(obs.get["n"])


def bucket_spec(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """(bucket columns, bucket count); ([], 0) for an unbucketed table."""
    info = table_info(spark, name)
    n = int(info.get("Num Buckets", "0") or 0)
    if n <= 0:
        return [], 0
    cols = [c.strip().strip("`") for c in info.get("Bucket Columns", "").strip("[]").split(",")]
    return [c for c in cols if c], n


def clustered_for_write(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """``REBALANCE`` by the partition columns of a partitioned table: few files per partition, and
    AQE splits a hot partition over several tasks.  Unchanged otherwise."""
    return df.hint("rebalance", *parts) if parts else df


def observed(df: DataFrame, observation, metrics: Sequence[Column], drop_after: Sequence[str]) -> DataFrame:
    """``metrics`` on the rows as they are written: in the final stage, where Spark applies each
    partition's metrics exactly once.  ``drop_after`` columns are only there for it."""
    if observation is not None:
        df = df.observe(observation, *metrics)
    return df.drop(*drop_after) if drop_after else df


def write_snapshot(spark: SparkSession, name: str, df: DataFrame, observation=None,
                   metrics: Sequence[Column] = (), drop_after: Sequence[str] = (), info: TableInfo | None = None) -> str:
    """Write ``df`` (already in the table's column order) as a new snapshot directory of an
    unpartitioned table; the table is not switched yet."""
    loc = new_snapshot_location((info.location if info else table_location(spark, name)).rsplit("/", 1)[0])
    observed(df, observation, metrics, drop_after).write.mode("errorifexists").parquet(loc)
    return loc


def switch_snapshot(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {check_name(name)} SET LOCATION {sql_string(location)}")
    spark.catalog.refreshTable(name)


_MODE, _MODE_LOCK = "spark.sql.sources.partitionOverwriteMode", threading.RLock()


def overwrite_partitions(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Replace the partitions that ``df``, in the table's column order, has rows for: Spark's dynamic
    partition overwrite, which may read the table it writes.  The session's mode is put back
    afterwards; writers of one session take turns."""
    with _MODE_LOCK:
        old = spark.conf.get(_MODE, None)
        spark.conf.set(_MODE, "dynamic")
        try:
            df.write.mode("overwrite").insertInto(name)
        finally:
            if old is None:
                spark.conf.unset(_MODE)
            else:
                spark.conf.set(_MODE, old)
    spark.catalog.refreshTable(name)


def stored_partitions(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Partition values as Spark stores them: an empty string is NULL."""
    text = [c for c in parts if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in text}) if text else df


_HIT = "_lf_touched"


def touched_table(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Distinct partition values of ``df``, marked for :func:`in_partitions`."""
    return df.select(*parts).distinct().withColumn(_HIT, F.lit(1))


def in_partitions(df: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of the table ``df`` in the touched partitions, found by joins: on the values where none is
    NULL (dynamic partition pruning then skips the other partitions' files), and null-safe in the
    partitions with a NULL, which a static filter selects."""
    some_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in parts])
    # the comparison is always true; it tells Spark that pruning by this side is worthwhile
    t = touched.where(F.col(_HIT) >= 1).select(*[F.col(c).alias(f"_t_{c}") for c in parts])
    t_null = reduce(lambda a, b: a | b, [F.col(f"_t_{c}").isNull() for c in parts])
    plain = df.where(~some_null).join(t.where(~t_null), [F.col(c) == F.col(f"_t_{c}") for c in parts], "left_semi")
    nulls = df.where(some_null).join(
        t.where(t_null), [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in parts], "left_semi")
    return plain.unionByName(nulls)


def drop_partitions(spark: SparkSession, name: str, parts: Sequence[str], values) -> None:
    """Drop partitions that a rewrite left without rows, with their files: a later append into such
    a partition must not find them again.  One that the table does not have (a conditional merge kept the
    target's row in another) is passed over; any other metastore error is raised."""
    jvm = spark.sparkContext._jvm
    for v in values:
        spec = ", ".join(f"`{c}` = " + ("NULL" if v[c] is None else sql_string(str(v[c]))) for c in parts)
        try:
            rows = spark.sql(f"DESCRIBE TABLE EXTENDED {check_name(name)} PARTITION ({spec})").collect()
        except AnalysisException as e:
            if e.getCondition() != "PARTITIONS_NOT_FOUND":
                raise
            continue
        path = jvm.org.apache.hadoop.fs.Path(next(r.data_type for r in rows if r.col_name == "Location"))
        spark.sql(f"ALTER TABLE {name} DROP PARTITION ({spec})")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    if values:
        spark.catalog.refreshTable(name)


def _old_folders(spark: SparkSession, root: str, older_than_seconds: float, keep=lambda n: False):
    """(path, name) of folders directly below ``root`` older than the grace
    period and not kept; deleted by the caller's loop."""
    import time

    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return fs, []
    cutoff_ms = (time.time() - older_than_seconds) * 1000
    out = [(st.getPath(), st.getPath().getName()) for st in fs.listStatus(path)
           if st.isDirectory() and st.getModificationTime() <= cutoff_ms
           and not keep(st.getPath().getName())]
    return fs, out


def clean_scratch(spark: SparkSession, older_than_seconds: float = 86400) -> list[str]:
    """Remove staging tables a crashed run left behind: every folder of the
    scratch schema older than the grace period goes, with its catalog entry
    when one is still registered.  Returns the removed folders."""
    from layerflow.session import scratch_schema, scratch_schema_location

    schema, root = scratch_schema(spark), scratch_schema_location(spark)
    registered = {t.name for t in spark.catalog.listTables(schema)}
    fs, old = _old_folders(spark, root, older_than_seconds)
    removed = []
    for p, n in old:
        if n in registered:
            spark.sql(f"DROP TABLE IF EXISTS {schema}.{check_name(n)}")
        if fs.exists(p):
            fs.delete(p, True)
        removed.append(p.toString())
    return removed


def expire_snapshots(spark: SparkSession, name: str, older_than_seconds: float = 3600) -> list[str]:
    """Delete the snapshot folders of ``name`` other than its current location that are older than
    the grace period (queries still reading an old snapshot keep working).  Returns the deleted
    folders.  One directory listing and one recursive delete per expired folder; no file is listed."""
    loc = table_location(spark, name).rstrip("/")
    root, current = loc.rsplit("/", 1)
    fs, old = _old_folders(spark, root, older_than_seconds,
                           keep=lambda n: not n.startswith("snap-") or n == current)
    for p, _ in old:
        fs.delete(p, True)
    return [p.toString() for p, _ in old]


def replace_rows(spark: SparkSession, name: str, df: DataFrame, observation=None,
                 metrics: Sequence[Column] = (), drop_after: Sequence[str] = (), info: TableInfo | None = None) -> None:
    """Make ``df`` (which may read the table) the rows of ``name``; columns by name.  For a
    partitioned table: of the partitions that ``df`` has rows for.  ``info``: when already looked up."""
    from layerflow.operators.publish import stage  # staging is built on this module

    info, schema = info or describe(spark, name), spark.table(name).schema
    extra = [F.col(c) for c in drop_after]
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *extra)
    out = enforce_not_null(out, info.not_null, name)
    if info.partitions:
        overwrite_partitions(spark, name, observed(clustered_for_write(out, info.partitions), observation, metrics, drop_after))
    elif info.buckets:
        st = stage(spark, observed(out, observation, metrics, drop_after), name)
        try:
            st.frame(spark).write.mode("overwrite").insertInto(name)
        finally:
            st.drop(spark)
        spark.catalog.refreshTable(name)
    else:
        switch_snapshot(spark, name, write_snapshot(spark, name, out, observation, metrics, drop_after, info))


def add_column(spark: SparkSession, name: str, column: str, data_type: str,
               comment: str | None = None) -> None:
    """Additive schema evolution; old snapshot files read the column as NULL."""
    if column in spark.table(name).columns:
        return
    ddl = f"`{column}` {data_type}"
    if comment:
        ddl += f" COMMENT {sql_string(comment)}"
    spark.sql(f"ALTER TABLE {check_name(name)} ADD COLUMNS ({ddl})")
    spark.catalog.refreshTable(name)


def literal_rows(spark: SparkSession, rows: Sequence[dict], schema: T.StructType) -> DataFrame:
    """Literal rows (INSERT ... VALUES) with an explicit schema; columns not
    given are NULL."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def conditional(assignments: dict[str, Column], where: Column | None) -> dict[str, Column]:
    """SET c = v WHERE p  ->  c = CASE WHEN p THEN v ELSE c END (NULL p keeps)."""
    if where is None:
        return dict(assignments)
    return {c: F.when(where, v).otherwise(F.col(c)) for c, v in assignments.items()}
