"""Catalog table scans and the watermark-based incremental reads.

Between layers the watermark is the library's own load time: never NULL, one value per run, rising.
:func:`next_batch` reads the rows after the stored one.  A business column of a *source* may be NULL,
tie, or be stored as text; :func:`source_batch` reads it typed, from the stored value on (ties again) and
with the NULL rows, and the caller keeps the latest row per key.  :func:`late_batch` also reads what arrived
late, within a window below the stored value.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WATERMARK_PROPERTY = "layerflow.watermark"
_SPAN = re.compile(r"^\d+ (second|minute|hour|day|week|month)s?$", re.IGNORECASE)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def high_watermark(df: DataFrame, column: str):
    """Max of ``column``: one aggregate row, the only value sent to the driver."""
    return df.agg(F.max(column).alias("wm")).first()["wm"]


def incremental_read(source: DataFrame, column: str, last_value=None) -> DataFrame:
    """Rows strictly newer than ``last_value`` (all rows when it is None).

    Passing the watermark as a literal lets Catalyst push the predicate into
    the Parquet scan (row-group skipping) instead of joining against the
    target's max."""
    if last_value is None:
        return source
    bound = F.lit(last_value).cast(source.schema[column].dataType)
    return source.filter(F.col(column) > bound)


# A watermark travels as text made on the JVM side: TIMESTAMP values as
# microseconds since the epoch (independent of any time zone), everything
# else as its string cast.  No Python datetime conversion is involved.

def _token(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(value).cast("string")
    return value.cast("string")


def watermark_value(token: str, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(F.lit(int(token)))
    return F.lit(token).cast(data_type)


def next_batch(source: DataFrame, column: str, last_token: str | None = None
               ) -> tuple[DataFrame, str | None]:
    """The rows after ``last_token`` up to the current maximum of the load time ``column``, and the token
    of that maximum (None: nothing new).

    One small job reads only ``column`` of the newer rows (the lower bound is
    pushed into the scan) to fix the upper bound; rows that arrive while the
    batch runs are above it and wait for the next batch."""
    dt = source.schema[column].dataType
    if not isinstance(dt, (T.TimestampType, T.NumericType)):
        raise ValueError(f"{column} is {dt.simpleString()}, not a load time")
    c = F.col(column)
    newer = source
    if last_token is not None:
        newer = source.filter(c > watermark_value(last_token, dt))
    r = newer.agg(_token(F.max(column), dt).alias("wm"), F.count_if(c.isNull()).alias("nulls")).first()
    if last_token is None and r["nulls"]:
        raise ValueError(f"{r['nulls']} rows have no {column}; a load time is never NULL")
    if r["wm"] is None:
        return newer, None
    return newer.filter(c <= watermark_value(r["wm"], dt)), r["wm"]


def source_batch(source: DataFrame, column: str, last_token: str | None = None,
                 data_type: str | None = None) -> tuple[DataFrame, str | None]:
    """Rows of a source from the business watermark ``last_token`` on, and the new watermark.

    ``data_type`` reads a text column as that type; text without one is refused, because it would
    compare as text ('9' after '11').  Rows at the stored maximum are read again (a later row may
    tie with it), and so are rows without a value (or without one of that type); nothing newer
    keeps the old watermark.  Merging the latest row per key makes the repeats harmless."""
    dt = source.schema[column].dataType
    if data_type is None and isinstance(dt, T.StringType):
        raise ValueError(f"watermark column {column!r} is text; give its type")
    value = F.col(column).try_cast(data_type) if data_type else F.col(column)
    dt = source.select(value.alias("v")).schema["v"].dataType
    batch = source
    if last_token is not None:
        batch = source.filter((value >= watermark_value(last_token, dt)) | value.isNull())
    return batch, batch.agg(_token(F.max(value), dt).alias("wm")).first()["wm"] or last_token


def _window(column: str, last_token: str, lateness: str | int | float, data_type: str | None, schema: T.StructType
            ) -> tuple[Column, Column]:
    """(value, lower bound) of a lateness window: a number for a numeric watermark, else text such as
    ``"3 days"``."""
    value = F.col(column).try_cast(data_type) if data_type else F.col(column)
    dt = T.DataType.fromDDL(data_type) if data_type else schema[column].dataType
    if isinstance(dt, T.StringType):
        raise ValueError(f"watermark column {column!r} is text; give its type")
    last = watermark_value(last_token, dt)
    if isinstance(dt, T.NumericType):
        return value, last - F.lit(lateness)
    if not isinstance(lateness, str) or not _SPAN.match(lateness):
        raise ValueError(f"lateness {lateness!r} of a {dt.simpleString()} is not a span such as '3 days'")
    return value, last - F.expr(f"INTERVAL {lateness}")


def row_digest(columns: list[str]) -> Column:
    """Digest of a row's values as text, NULL and '' apart: the same for a typed row and its landed text."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])), 256)


def _not_landed(source: DataFrame, landed: DataFrame, inside) -> DataFrame:
    """Rows of ``source`` in a window that ``landed`` has not in the same window; only digests of the
    landed rows are moved."""
    old = landed.where(inside(landed.schema)).select(row_digest(source.columns).alias("_digest")).distinct()
    new = source.where(inside(source.schema)).withColumn("_digest", row_digest(source.columns))
    return new.join(old, "_digest", "left_anti").drop("_digest")


def late_batch(source: DataFrame, landed: DataFrame, column: str, last_token: str | None,
               lateness: str | int | float, data_type: str | None = None) -> tuple[DataFrame, str | None]:
    """:func:`source_batch` with a lateness window: rows whose business watermark is at most ``lateness``
    below the stored one are read again and, with those without a value, compared with the ``landed``
    rows by digest; the ones not landed yet are the batch.  ``landed`` has the source's columns, typed or
    as text.  Rows equal in every column are one to it."""
    kind = data_type or source.schema[column].dataType.simpleString()
    if last_token is None:
        return source_batch(source, column, None, data_type)

    def inside(schema: T.StructType) -> Column:
        value, bound = _window(column, last_token, lateness, _type_in(schema, column, kind), schema)
        return (value >= bound) | value.isNull()

    batch = _not_landed(source, landed, inside)
    _, token = source_batch(source, column, last_token, data_type)
    return batch, token


def too_late(source: DataFrame, landed: DataFrame, column: str, last_token: str, lateness: str | int | float,
             data_type: str | None = None) -> DataFrame:
    """The rows of ``source`` below the lateness window that were never landed: what :func:`late_batch`
    leaves out.  Reads the old part of both sides."""
    kind = data_type or source.schema[column].dataType.simpleString()

    def below(schema: T.StructType) -> Column:
        value, bound = _window(column, last_token, lateness, _type_in(schema, column, kind), schema)
        return value < bound

    return _not_landed(source, landed, below)


def _type_in(schema: T.StructType, column: str, kind: str) -> str | None:
    """The cast that ``column`` needs to be compared as ``kind``."""
    return kind if schema[column].dataType.simpleString() != kind else None


def history_of(batch: DataFrame, history: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """All rows of ``history`` with a key of ``batch`` (``keys``: the key expressions by name), so
    that the latest row per key is chosen among all that arrived, not among the new ones."""
    names = [f"_k_{k}" for k in keys]
    new = batch.select(*[v.alias(n) for n, v in zip(names, keys.values())]).distinct()
    old = history.withColumns({f"_h_{k}": v for k, v in keys.items()})
    same = [F.col(f"_h_{k}").eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return old.join(new, same, "left_semi").drop(*[f"_h_{k}" for k in keys])


def encode_watermark(source: str, column: str, token: str) -> str:
    return json.dumps({"source": source, "column": column, "value": token}, sort_keys=True)


def stored_watermark(properties: dict[str, str], source: str, column: str) -> str | None:
    """The token stored on a target for this source table and column; a
    watermark of another source or column does not apply."""
    raw = properties.get(WATERMARK_PROPERTY)
    if not raw:
        return None
    d = json.loads(raw)
    if d.get("source") != source or d.get("column") != column:
        return None
    return d.get("value")
