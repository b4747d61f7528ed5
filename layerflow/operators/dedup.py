"""Latest row per business key.

``row_number() OVER (PARTITION BY keys ORDER BY <order>, <tie-breakers>) = 1``.
Spark plans this as a partial ``WindowGroupLimit`` before the shuffle and a
final one after it, so a hot key (even NULL, which forms one group) sends at
most one row per map partition through the exchange.  The tie-breakers make
the order total, so the surviving row does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RN = "_rn"


#: Order columns: a name (descending) or (name, "asc" | "desc").
Order = Sequence[str | tuple[str, str]]


def _order_col(spec: str | tuple[str, str]) -> tuple[str, Column]:
    name, direction = (spec, "desc") if isinstance(spec, str) else spec
    c = F.col(name)
    c = c.desc_nulls_last() if direction.lower() == "desc" else c.asc_nulls_first()
    return name, c


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def total_order(schema: T.StructType, keys: Sequence[str], order: Order) -> list[tuple[str, str]]:
    """(column, direction): the given order, then every other orderable column ascending."""
    given = [(o, "desc") if isinstance(o, str) else (o[0], o[1].lower()) for o in order]
    used = {*keys, *(name for name, _ in given)}
    return given + [(f.name, "asc") for f in schema.fields if f.name not in used and _orderable(f.dataType)]


def dedup_order(df: DataFrame, keys: Sequence[str], order: Order) -> list[Column]:
    return [_order_col(spec)[1] for spec in total_order(df.schema, keys, order)]


def comes_before(schema: T.StructType, keys: Sequence[str], order: Order, prefix: str) -> Column:
    """Whether the row in the columns with ``prefix`` comes before the one without it, in the order of
    :func:`dedup_latest` (descending: NULLs last, ascending: NULLs first).  Rows equal in every column of
    the order come before neither."""
    before = F.lit(False)
    for name, direction in reversed(total_order(schema, keys, order)):
        new, old = F.col(prefix + name), F.col(name)
        if direction == "desc":
            first = new.isNotNull() & (old.isNull() | (new > old))
        else:
            first = old.isNotNull() & (new.isNull() | (new < old))
        before = F.coalesce(first, F.lit(False)) | (new.eqNullSafe(old) & before)
    return before


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order`` (names default to
    descending, NULLs last), ties broken by the remaining columns."""
    w = Window.partitionBy(*keys).orderBy(*dedup_order(df, keys, order))
    return df.withColumn(RN, F.row_number().over(w)).filter(F.col(RN) == 1).drop(RN)
