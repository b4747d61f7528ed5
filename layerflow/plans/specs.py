"""Ingestion metadata: one row per table drives all three layers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.operators import tables as tb

LAYERS = (0, 1, 2)


def _layer_fields(n: int) -> list[T.StructField]:
    s = T.StringType()
    out = [T.StructField(f"layer{n}_{c}", s) for c in
           ("target_catalog", "target_schema", "target_table", "script_path", "load_type")]
    if n > 0:
        out += [T.StructField(f"layer{n}_{c}", s) for c in
                ("merge_keys", "column_mapping", "transformation_rules")]
    out.append(T.StructField(f"layer{n}_is_active", T.BooleanType()))
    return out


# The metadata table's columns, in declared order.
METADATA_SCHEMA = T.StructType(
    [T.StructField("table_id", T.StringType(), False)]
    + [T.StructField(c, T.StringType()) for c in
       ("source_system", "source_schema", "source_table", "reporting_unit_id")]
    + _layer_fields(0) + _layer_fields(1) + _layer_fields(2)
    + [T.StructField("partition_column", T.StringType()),
       T.StructField("watermark_column", T.StringType()),
       T.StructField("created_ts", T.TimestampType()),
       T.StructField("updated_ts", T.TimestampType()),
       T.StructField("table_group", T.StringType()),
       T.StructField("table_is_active", T.BooleanType())]
)


@dataclass(frozen=True)
class LayerSpec:
    layer: int
    target_catalog: str | None
    target_schema: str | None
    target_table: str | None
    script_path: str | None
    load_type: str | None
    is_active: bool | None
    merge_keys: str | None = None
    column_mapping: str | None = None
    transformation_rules: str | None = None

    @property
    def table_name(self) -> str:
        parts = [p for p in (self.target_catalog, self.target_schema, self.target_table) if p]
        return ".".join(parts)


@dataclass(frozen=True)
class TableSpec:
    table_id: str
    source_system: str | None = None
    source_schema: str | None = None
    source_table: str | None = None
    reporting_unit_id: str | None = None
    table_group: str | None = None
    partition_column: str | None = None
    watermark_column: str | None = None
    table_is_active: bool | None = True
    layers: dict[int, LayerSpec] = field(default_factory=dict)

    def layer(self, n: int) -> LayerSpec:
        return self.layers[int(n)]


def table_spec(row) -> TableSpec:
    d = row.asDict() if hasattr(row, "asDict") else dict(row)
    layers = {}
    for n in LAYERS:
        g = lambda c, n=n: d.get(f"layer{n}_{c}")
        layers[n] = LayerSpec(n, g("target_catalog"), g("target_schema"), g("target_table"),
                              g("script_path"), g("load_type"), g("is_active"),
                              g("merge_keys"), g("column_mapping"), g("transformation_rules"))
    return TableSpec(d["table_id"], d.get("source_system"), d.get("source_schema"),
                     d.get("source_table"), d.get("reporting_unit_id"), d.get("table_group"),
                     d.get("partition_column"), d.get("watermark_column"),
                     d.get("table_is_active"), layers)


def metadata_frame(spark: SparkSession, rows: list[dict], default_active: bool = True) -> DataFrame:
    """INSERT ... VALUES for metadata; unnamed columns are NULL except
    ``table_is_active``, which defaults to ``default_active``."""
    rows = [dict({"table_is_active": default_active}, **r) for r in rows]
    return tb.literal_rows(spark, rows, METADATA_SCHEMA)


def active_tables(meta: DataFrame, table_group: str | None = None) -> DataFrame:
    """Active table ids in id order; NULL ``table_is_active`` counts as off.
    ``table_group`` narrows to one group (DIMENSION, FACT, ...)."""
    df = meta.filter(F.col("table_is_active"))
    if table_group is not None:
        df = df.filter(F.col("table_group") == F.lit(table_group))
    return df.select("table_id").orderBy("table_id")


def metadata_row(meta: DataFrame, table_id: str) -> DataFrame:
    return meta.filter(F.col("table_id") == F.lit(table_id))


def lookup(meta: DataFrame, table_id: str) -> TableSpec:
    """The one metadata row for ``table_id`` (at most two rows reach the
    driver: enough to detect a duplicate id)."""
    rows = metadata_row(meta, table_id).limit(2).collect()
    if not rows:
        raise LookupError(f"Metadata not found for {table_id}")
    if len(rows) > 1:
        raise LookupError(f"Metadata has more than one row for {table_id}")
    return table_spec(rows[0])


def active_ids(meta: DataFrame, table_group: str | None = None) -> list[str]:
    """Driver list for the run loop (metadata only: one row per table)."""
    return [r.table_id for r in active_tables(meta, table_group).collect()]
