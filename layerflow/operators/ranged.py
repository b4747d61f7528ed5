"""Unpartitioned targets clustered by key range: a MERGE or UPDATE rewrites the ranges it touches, not the table.

A ranged table ``t`` is three objects of Spark's catalog:

- ``t_data``: the rows, partitioned by a range id (a plain Spark partition column);
- ``t_ranges``: one row per live range: its id, its lowest key (NULL: no lower end) and its number of rows;
- ``t``: a view of the rows whose range is live, without the id.

A rewrite reads the partitions of the ranges that its keys fall into, writes their new rows as partitions with ids
never used before, and then switches ``t_ranges`` to a snapshot that lists the new ids in place of the old: one
metastore call, so a reader sees the table before or after, and a run that is lost before it leaves only partitions
that no reader sees.  A range that would pass ``rows`` rows is written as several, cut at keys of a sample (a matter
of layout only).  :func:`expire_ranges` removes what is no longer live.  One writer at a time is assumed.

The range of a row follows from the first merge key alone, so all rows of a key are in one range, repeated ones
too.  Rows without that key are in the first range and match nothing.  The ranges are known to the driver (the
table's size by the size of a range, as the catalog's partitions are).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.operators import tables as tb
from layerflow.operators import upsert as up
from layerflow.operators.dedup import Order
from layerflow.operators.publish import MergeCardinalityError, WriteResult, stage

RANGE = "_range"
KEYS_PROPERTY, ROWS_PROPERTY = "layerflow.range_key", "layerflow.range_rows"
RANGE_ROWS = 4_000_000
SAMPLE_A_RANGE = 64
_HASH = 1 << 40
_KINDS = (T.IntegralType, T.DecimalType, T.StringType, T.DateType)


def data_table(name: str) -> str:
    return f"{name}_data"


def ranges_table(name: str) -> str:
    return f"{name}_ranges"


def is_ranged(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(ranges_table(name)) and spark.catalog.tableExists(data_table(name))


def create_ranged(spark: SparkSession, name: str, schema: T.StructType, key: str, root: str,
                  rows: int = RANGE_ROWS) -> bool:
    """An empty ranged table below ``root``; False if it is there."""
    if is_ranged(spark, name):
        return False
    kind = schema[key].dataType
    if not isinstance(kind, _KINDS):
        raise ValueError(f"{key} is {kind.simpleString()}: ranges are of integers, decimals, dates or text")
    tb.create_table(spark, data_table(name), T.StructType([*schema.fields, T.StructField(RANGE, T.StringType())]), f"{root}/data", partition_by=[RANGE], properties={KEYS_PROPERTY: key, ROWS_PROPERTY: str(rows)})
    listed = T.StructType([T.StructField(RANGE, T.StringType()), T.StructField("lo", kind), T.StructField("n", T.LongType())])
    tb.create_table(spark, ranges_table(name), listed, f"{root}/ranges")
    tb.append_rows(spark, ranges_table(name), spark.createDataFrame([(_new_id(), None, 0)], listed))
    columns = ", ".join(f"`{f.name}`" for f in schema.fields)
    spark.sql(f"CREATE VIEW {tb.check_name(name)} AS SELECT {columns} FROM {data_table(name)} "
              f"WHERE {RANGE} IN (SELECT {RANGE} FROM {ranges_table(name)})")
    return True


def _new_id() -> str:
    return uuid.uuid4().hex


def live_ranges(spark: SparkSession, name: str) -> list[tuple]:
    """(id, lowest key, rows) in the order of the keys; the first has no lower end."""
    return [tuple(r) for r in spark.table(ranges_table(name)).orderBy(F.col("lo").asc_nulls_first()).collect()]


def range_of(key: Column, ranges: Sequence[tuple], kind: T.DataType) -> Column:
    """The id of the range that ``key`` falls into, by two searches in sorted literal arrays of about the
    square root of their number."""
    ids, size = [r[0] for r in ranges], isqrt(len(ranges) - 1) + 1
    los = [F.lit(r[1]).cast(kind) for r in ranges]
    groups = range(0, len(ids), size)

    def below(sorted_los: Column) -> Column:
        return F.size(F.filter(sorted_los, lambda lo: lo <= key))

    starts = F.array(*[los[g] for g in groups][1:]).cast(T.ArrayType(kind))
    group = below(starts) + 1
    inner = F.array(*[F.array(*los[g + 1:g + size]).cast(T.ArrayType(kind)) for g in groups])
    named = F.array(*[F.array(*[F.lit(i) for i in ids[g:g + size]]) for g in groups])
    found = F.element_at(F.element_at(named, group), below(F.element_at(inner, group)) + 1)
    return F.when(key.isNull(), F.lit(ids[0])).otherwise(found)


def _sampled(keys: DataFrame, key: str, share: dict[str, float]) -> DataFrame:
    """A share of the keys of each of the given ranges, picked by a hash where the keys are: a shuffle by range
    would bring all keys of a first load, which has one range, to one task."""
    wanted = keys.sparkSession.createDataFrame([(r, int(s * _HASH)) for r, s in share.items()], f"{RANGE} string, most long")
    return keys.join(F.broadcast(wanted), RANGE).where(F.pmod(F.xxhash64(key, F.lit(11)), F.lit(_HASH)) < F.col("most"))


def _cuts(keys: DataFrame, key: str, pieces: dict[str, int], rows: dict[str, int]) -> dict[str, list]:
    """New lowest keys inside the ranges that are to become several: quantiles of a sample of their keys."""
    if not pieces:
        return {}
    some = _sampled(keys, key, {r: min(1.0, SAMPLE_A_RANGE * k / max(rows[r], 1)) for r, k in pieces.items()})
    lists = some.where(F.col(key).isNotNull()).groupBy(RANGE).agg(F.sort_array(F.collect_set(key)).alias("keys"))
    out = {}
    for r in lists.collect():
        k, at = pieces[r[RANGE]], r["keys"]
        out[r[RANGE]] = list(dict.fromkeys(at[len(at) * i // k] for i in range(1, k) if len(at) * i // k))
    return out


def _rewrite(spark: SparkSession, name: str, rows: DataFrame, touched: dict[str, int], ranges: list[tuple], key: str,
             keys: DataFrame, metrics: Sequence[Column] = (), drop_after: Sequence[str] = ()) -> dict:
    """``rows`` become all rows of the ``touched`` ranges (id -> rows expected, at most): written under new
    ids, cut where too many, then switched.  ``keys`` has their keys and present ids."""
    data, kind = data_table(name), spark.table(ranges_table(name)).schema["lo"].dataType
    most = int(tb.table_properties(spark, data)[ROWS_PROPERTY])
    # half full, so that a range is not cut again at the next rows
    pieces = {r: ceil(2 * n / most) for r, n in touched.items() if n > most}
    cuts = _cuts(keys, key, pieces, touched)
    new = [(_new_id(), lo, 0) for r in ranges if r[0] in touched for lo in [r[1], *[c for c in cuts.get(r[0], []) if c != r[1]]]]
    kept = [r for r in ranges if r[0] not in touched]
    # a key of an untouched range cannot occur; one below the first touched range cannot either
    out = rows.withColumn(RANGE, range_of(F.col(key), new, kind))
    obs = Observation()
    written = tb.enforce_not_null(out, tb.not_null_columns(spark, data), name)
    target = spark.table(data).columns
    written = written.select(*target, *[c for c in drop_after]).hint("rebalance", RANGE)
    tb.observed(written, obs, [F.count(F.lit(1)).alias("_rows"), *metrics], drop_after).write.mode("append").insertInto(data)
    spark.catalog.refreshTable(data)
    counts = {r[RANGE]: r["n"] for r in spark.table(data).where(F.col(RANGE).isin([r[0] for r in new])).groupBy(RANGE).agg(
        F.count("*").alias("n")).collect()}
    # ranges without rows stay listed: the keys must have no gap
    listed = [*kept, *[(i, lo, counts.get(i, 0)) for i, lo, _ in new]]
    at = ranges_table(name)
    state = spark.createDataFrame(listed, spark.table(at).schema).coalesce(1)
    tb.switch_snapshot(spark, at, tb.write_snapshot(spark, at, state))
    spark.catalog.refreshTable(name)
    return obs.get


def merge_ranged(spark: SparkSession, df: DataFrame, name: str, keys: Sequence[str],
                 newer_by: Order | None = None) -> WriteResult:
    """Upsert ``df`` into the ranged table ``name``, as :func:`layerflow.operators.publish.publish` does into
    others; only the ranges of the source's keys are read and written."""
    data = spark.table(data_table(name))
    key = tb.table_properties(spark, data_table(name))[KEYS_PROPERTY]
    if key not in keys:
        raise ValueError(f"{name} is clustered by {key}, which is not a merge key of {list(keys)}")
    columns = [c for c in data.columns if c != RANGE]
    ranges, kind = live_ranges(spark, name), data.schema[key].dataType
    src = up.align_to(df, T.StructType([data.schema[c] for c in columns]))
    staged = stage(spark, src.withColumn(RANGE, range_of(F.col(key), ranges, kind)), name)
    try:
        src = staged.frame(spark)
        added = {r[RANGE]: r["n"] for r in src.groupBy(RANGE).agg(F.count("*").alias("n")).collect()}
        if not added:
            return WriteResult(strategy="ranges")
        scope = in_ranges(data, list(added))
        read, repeated = up.source_profile(src, keys)
        if newer_by:
            src = up.newest_per_key(src, keys, newer_by)
        elif repeated and up.ambiguous_keys(scope, src, keys).limit(1).count():
            raise MergeCardinalityError(f"more than one source row for a target row with keys {list(keys)} in {name}")
        touched = {r[0]: r[2] + added[r[0]] for r in ranges if r[0] in added}
        own = [RANGE, key]
        m = _rewrite(spark, name, up.merged(scope.drop(RANGE), src.drop(RANGE), keys, newer_by), touched, ranges, key,
                     scope.select(*own).unionByName(src.select(*own)), up.merge_metrics_columns(), [up.OP])
        return WriteResult(read, int(m["inserted"]), int(m["updated"]), strategy="ranges")
    finally:
        staged.drop(spark)


def in_ranges(data: DataFrame, ids: list[str]) -> DataFrame:
    """Rows of the given ranges: a literal filter on the partition column, so other ranges are not listed."""
    return data.where(F.col(RANGE).isin(ids))


def update_ranged(spark: SparkSession, name: str, assignments: dict[str, Column], where: Column | None = None) -> int:
    """``UPDATE name SET ... WHERE ...``; only ranges with a matching row are rewritten.  The clustering key
    cannot be assigned: its rows would change their range.  Returns the rows updated."""
    data = spark.table(data_table(name))
    key = tb.table_properties(spark, data_table(name))[KEYS_PROPERTY]
    if key in assignments:
        raise ValueError(f"{name} is clustered by {key}: delete and insert instead")
    ranges = live_ranges(spark, name)
    rows = in_ranges(data, [r[0] for r in ranges])
    hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    found = {r[RANGE] for r in rows.where(hit).select(RANGE).distinct().collect()}
    touched = {r[0]: r[2] for r in ranges if r[0] in found}
    if not touched:
        return 0
    scope = in_ranges(data, list(touched))
    changed = scope.withColumns({**tb.conditional(assignments, where), up.OP: F.when(hit, "U").otherwise("K")})
    m = _rewrite(spark, name, changed.drop(RANGE), touched, ranges, key, scope.select(RANGE, key),
                 up.merge_metrics_columns(), [up.OP])
    return int(m["updated"])


def expire_ranges(spark: SparkSession, name: str, older_than_seconds: float = 3600) -> int:
    """Drop the partitions of ranges that are no longer live and older than the grace period (readers of the
    state before keep working until then), and replaced snapshots of the range list.  Returns how many."""
    data, at = data_table(name), ranges_table(name)
    live = {r[0] for r in live_ranges(spark, name)}
    dead = [v for r in spark.sql(f"SHOW PARTITIONS {tb.check_name(data)}").collect()
            if (v := r[0].split("=", 1)[1]) not in live]
    jvm = spark.sparkContext._jvm
    old = []
    for v in dead:
        path = jvm.org.apache.hadoop.fs.Path(f"{tb.table_location(spark, data)}/{RANGE}={v}")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        age = jvm.java.lang.System.currentTimeMillis() - fs.getFileStatus(path).getModificationTime() if fs.exists(path) else None
        if age is None or age >= older_than_seconds * 1000:
            old.append({RANGE: v})
    tb.drop_partitions(spark, data, [RANGE], old)
    tb.expire_snapshots(spark, at, older_than_seconds)
    return len(old)
