"""Keyed upsert (MERGE: matched -> update all, not matched -> insert all, unmatched target rows stay) as
two plain joins.

- target LEFT JOIN source: a target row whose key is in the source becomes the source row (``U``), any
  other stays (``K``).  Repeated target keys are all updated.
- source LEFT ANTI JOIN target: the source rows of keys that the target lacks (``I``), repeats included.

With an order (``newer_by``) the MERGE is conditional: a matched target row becomes the source row only where that
is newer, else it stays (``K``).  One source row per key is compared, the newest; the order is the one of
:func:`layerflow.operators.dedup.dedup_latest`, so the target ends with the row that a dedup of all rows that ever
arrived would pick, without reading them again.

No hints: Spark and AQE choose broadcast or sort-merge from the sizes they see, with the same rows
either way, and split skewed partitions of the target and of the inserts.  A NULL in any key never
matches (SQL ``=``).  Two source rows for one *target* row are an error, found beforehand by a count
that aggregates before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.operators.dedup import Order, comes_before, dedup_latest

OP = "_op"


def parse_keys(merge_keys: str | Sequence[str] | None) -> list[str]:
    """``"a, b"`` or ``["a", "b"]`` -> ``["a", "b"]``; none is an error."""
    if merge_keys is None:
        merge_keys = []
    keys = merge_keys.split(",") if isinstance(merge_keys, str) else list(merge_keys)
    keys = [k.strip() for k in keys if k and k.strip()]
    if not keys:
        raise ValueError("merge needs at least one key column")
    return keys


def any_null(keys: Sequence[str], prefix: str = "") -> Column:
    return reduce(lambda a, b: a | b, [F.col(prefix + k).isNull() for k in keys])


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The target's columns by name and type; extra source columns are
    ignored, a missing one is an error."""
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _renamed(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])


def _same_key(keys: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(k) == F.col(prefix + k) for k in keys]


def newest_per_key(source: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row per key under ``order``; rows with a NULL in the key match nothing and all stay."""
    return dedup_latest(source.where(~any_null(keys)), keys, order).unionByName(source.where(any_null(keys)))


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str], newer_by: Order | None = None) -> DataFrame:
    """Rows after the MERGE, tagged in ``_op`` (U, K, I).  ``source`` has the target's columns; with
    ``newer_by`` it has one row per key."""
    keys, cols = list(keys), target.columns
    s = _renamed(source, cols, "_s_").withColumn("_m", F.lit(True))
    hit = F.col("_m").isNotNull()
    if newer_by:
        hit = F.coalesce(hit & comes_before(target.schema, keys, newer_by, "_s_"), F.lit(False))
    kept = target.join(s, _same_key(keys, "_s_"), "left").select(
        *[F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) for c in cols],
        F.when(hit, F.lit("U")).otherwise(F.lit("K")).alias(OP))
    new = source.join(_renamed(target, keys, "_t_"), _same_key(keys, "_t_"), "left_anti")
    return kept.unionByName(new.withColumn(OP, F.lit("I")))


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL key values that occur more than once, with their count.
    Partial aggregation runs before the shuffle, so a hot key costs one row
    per map partition."""
    keys = list(keys)
    return (source.filter(~any_null(keys)).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1))


def source_profile(source: DataFrame, keys: Sequence[str]) -> tuple[int, bool]:
    """(rows, whether a non-NULL key repeats): one job over the key columns."""
    g = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    r = g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
              F.count_if((F.col("n") > 1) & ~any_null(keys)).alias("repeated")).first()
    return int(r["rows"]), int(r["repeated"]) > 0


def ambiguous_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur in the target and more than once in the source."""
    return duplicate_keys(source, keys).join(_renamed(target, list(keys), "_t_"), _same_key(keys, "_t_"), "left_semi")


def merge_metrics_columns() -> list[Column]:
    """Aggregates for an ``Observation`` over an upsert output."""
    return [F.count_if(F.col(OP) == "I").alias("inserted"), F.count_if(F.col(OP) == "U").alias("updated")]
