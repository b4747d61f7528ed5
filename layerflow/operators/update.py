"""UPDATE ... SET ... [WHERE ...] and additive schema evolution: one pass that rewrites the touched
part of a table with conditional projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerflow.operators import tables as tb
from layerflow.operators.publish import FILE_PROVIDERS, drop_emptied, stage
from layerflow.operators.ranged import is_ranged, update_ranged

_HIT = "_lf_hit"


def update_rows(df: DataFrame, assignments: dict[str, Column],
                where: Column | None = None) -> DataFrame:
    """Rows of ``df`` with ``assignments`` applied where ``where`` is true
    (every row when it is None; a NULL predicate leaves the row as is)."""
    return df.withColumns(tb.conditional(assignments, where))


def update_table(spark: SparkSession, table: str, assignments: dict[str, Column | str],
                 where: Column | str | None = None) -> int:
    """Apply the update to ``table``; returns the rows matched.  Nothing is written when no row matches.

    On a partitioned table only the partitions with matching rows, and those that rows move to, are
    rewritten; partitions left empty are dropped.  On a ranged table only the ranges with matching rows are.
    On a table format with row-level operations the
    format's own UPDATE runs, which needs assignments and predicate as SQL text."""
    if is_ranged(spark, table):
        return update_ranged(spark, table, {c: F.expr(v) if isinstance(v, str) else v for c, v in assignments.items()},
                             F.expr(where) if isinstance(where, str) else where)
    df, info = spark.table(table), tb.describe(spark, table)
    parts = list(info.partitions)
    if info.provider not in FILE_PROVIDERS:
        return _update_by_format(spark, df, table, assignments, where)
    assignments = {c: F.expr(v) if isinstance(v, str) else v for c, v in assignments.items()}
    where = F.expr(where) if isinstance(where, str) else where
    hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    matched = df.filter(hit)
    if not parts:
        if where is not None and not matched.limit(1).count():
            return 0
        return _rewrite(spark, table, df, hit, assignments, where, info)[0]
    moves = bool(set(parts) & set(assignments))
    own = matched.select(*parts)
    if moves:
        new = matched.select(*[assignments.get(c, F.col(c)).cast(df.schema[c].dataType).alias(c) for c in parts])
        own = own.unionByName(tb.stored_partitions(new, parts))
    touched = stage(spark, tb.touched_table(own, parts), table)
    try:
        if not touched.rows:
            return 0
        scope = tb.in_partitions(df, touched.frame(spark), parts)
        n, written = _rewrite(spark, table, scope, hit, assignments, where, info)
        if moves:
            drop_emptied(spark, table, touched.frame(spark), parts, written)
        return n
    finally:
        touched.drop(spark)


def _rewrite(spark, table, df, hit, assignments, where, info) -> tuple[int, list]:
    # the match flag rides along to the final stage, where it is counted
    parts = list(info.partitions)
    out = tb.stored_partitions(update_rows(df.withColumn(_HIT, hit), assignments, where), parts)
    metrics = [F.count_if(F.col(_HIT)).alias("n")]
    if parts:     # the partitions that keep rows
        metrics.append(F.collect_set(F.struct(*parts)).alias("_parts"))
    obs = Observation()
    tb.replace_rows(spark, table, out, obs, metrics, [_HIT], info)
    return int(obs.get["n"]), obs.get.get("_parts", [])


def _update_by_format(spark, df, table, assignments, where) -> int:
    if not all(isinstance(x, str) for x in [*assignments.values(), where or ""]):
        raise TypeError(f"{table}: UPDATE by the table format takes SQL text")
    n = (df.filter(where) if where else df).count()
    sets = ", ".join(f"`{c}` = {v}" for c, v in assignments.items())
    spark.sql(f"UPDATE {tb.check_name(table)} SET {sets}" + (f" WHERE {where}" if where else ""))
    return n


def add_column_with_backfill(spark: SparkSession, table: str, column: str, data_type: str,
                             value, comment: str | None = None) -> int:
    """ALTER TABLE ADD COLUMN, then SET column = value WHERE column IS NULL."""
    tb.add_column(spark, table, column, data_type, comment)
    return update_table(spark, table, {column: F.lit(value).cast(data_type)},
                        F.col(column).isNull())
