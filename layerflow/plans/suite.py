"""The registered queries: each runs library code over the driver's test
tables (whole tables, no row caps) and returns a DataFrame whose columns
match the DuckDB oracle in :mod:`layerflow.plans.oracle`.

Each query works in its own fresh schema and folder below the shared root,
so queries can run in any order, in one session, any number of times.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.functions.rules import REJECT_COLUMN
from layerflow.operators import tables as tb
from layerflow.operators.compaction import AutoCompact, compact_appends
from layerflow.operators.dedup import dedup_latest
from layerflow.operators.publish import MergeCardinalityError, publish
from layerflow.operators.ranged import expire_ranges, live_ranges
from layerflow.operators.update import add_column_with_backfill, update_table
from layerflow.operators.upsert import ambiguous_keys
from layerflow.plans import audit as au
from layerflow.plans import dims, specs
from layerflow.plans import sources_sql as S
from layerflow.plans.pipeline import LayerContext, Pipeline, PipelineConfig, RunFailed, land_source, register
from layerflow.plans.transforms import curate, enrich, land
from layerflow.session import RunContext, scratch_dir
from layerflow.sources.files import LINEAGE_COLUMNS, stage_csv, with_lineage
from layerflow.sources.tables import (high_watermark, history_of, incremental_read, late_batch, source_batch,
                                      too_late)
from layerflow.streaming.landing import land_available

UTC = dt.timezone.utc
# The two landing runs every query uses.
RUN1 = RunContext("run-1", dt.datetime(2024, 1, 1, tzinfo=UTC))
RUN2 = RunContext("run-2", dt.datetime(2024, 1, 2, tzinfo=UTC))


class Workspace:
    """A private schema + folder for one query run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir.rstrip("/")
        self.root = scratch_dir(spark, "ws")
        self.schema = "lf_" + uuid.uuid4().hex[:12]
        tb.create_schema(spark, self.schema, location=f"{self.root}/_schema")

    def t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf}/{name}.parquet")

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def table_root(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def stage(self, df: DataFrame, tag: str) -> str:
        return stage_csv(df, f"{self.root}/drop/{tag}-{uuid.uuid4().hex[:8]}")


def _sel(df: DataFrame, exprs) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {c}" for c, e in exprs])


def _customer_src(ws: Workspace) -> DataFrame:
    n = ws.t("nation").filter(F.col("n_regionkey") != 4)
    return ws.t("customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")


def _landed(ws: Workspace, frames: list[DataFrame], columns, run: RunContext, tag: str) -> DataFrame:
    path = ws.stage(reduce(DataFrame.unionByName, frames), tag)
    return land(ws.spark, path, run, columns)


def product_raw(ws: Workspace) -> DataFrame:
    """Two landings of `part`: run 1 with old descriptions, run 2 current
    rows plus a same-time twin of every row."""
    p = ws.t("part")
    old = _landed(ws, [_sel(p, S.product_exprs("old"))], dims.PRODUCT_RAW, RUN1, "product1")
    new = _landed(ws, [_sel(p, S.product_exprs("new")), _sel(p, S.product_exprs("new_twin"))],
                  dims.PRODUCT_RAW, RUN2, "product2")
    return old.unionByName(new)


def customer_raw(ws: Workspace) -> DataFrame:
    c = _customer_src(ws)
    old = _landed(ws, [_sel(c, S.customer_exprs("old"))], dims.CUSTOMER_RAW, RUN1, "customer1")
    new = _landed(ws, [_sel(c, S.customer_exprs("new"))], dims.CUSTOMER_RAW, RUN2, "customer2")
    return old.unionByName(new)


def entities_raw(ws: Workspace) -> DataFrame:
    return _landed(ws, [_sel(ws.t("supplier"), S.ENTITIES)], dims.ENTITIES_RAW, RUN2, "entities")


def _curated(ws: Workspace, d: dims.Dimension, raw: DataFrame) -> DataFrame:
    return curate(raw, d.rules, [d.key], RUN2)


def _out(df: DataFrame) -> DataFrame:
    """Compared columns: the reject list left out, timestamps rendered as text."""
    df = df.drop(REJECT_COLUMN)
    return df.withColumns({f.name: F.col(f.name).cast("string") for f in df.schema.fields
                           if f.dataType.typeName() in ("timestamp", "timestamp_ntz")})


# ---------------------------------------------------------------- landing

def q_land_csv(spark, sf):
    ws = Workspace(spark, sf)
    path = ws.stage(_sel(ws.t("part"), S.product_exprs("new")), "land")
    return _out(land(spark, path, RUN2, dims.PRODUCT_RAW).drop("source_file_name", "job_run_id"))


def q_land_lineage(spark, sf):
    ws = Workspace(spark, sf)
    o = ws.t("orders").selectExpr("CAST(o_orderkey AS STRING) AS O_ORDERKEY",
                                  "o_orderstatus AS O_ORDERSTATUS")
    df = land(spark, ws.stage(o, "orders"), RUN2, ["O_ORDERKEY", "O_ORDERSTATUS"])
    return df.select("O_ORDERKEY", "O_ORDERSTATUS",
                     F.col("source_file_name").endswith(".csv").alias("from_csv_file"),
                     F.col("ingestion_timestamp").cast("string").alias("ingestion_timestamp"),
                     "job_run_id")


def q_table_scan(spark, sf):
    ws = Workspace(spark, sf)
    name = ws.name("part_copy")
    publish(spark, ws.t("part"), name, "APPEND", root=ws.table_root("part_copy"))
    return spark.table(name)


def q_land_csv_reordered(spark, sf):
    ws = Workspace(spark, sf)
    return _out(land(spark, _reordered_drop(ws, "reordered"), RUN2, dims.PRODUCT_RAW).drop("source_file_name", "job_run_id"))


def q_stream_land(spark, sf):
    ws = Workspace(spark, sf)
    drop = ws.stage(_sel(ws.t("part"), S.product_exprs("new")), "stream")
    name = ws.name("product_raw")
    tb.create_table(spark, name, dims.PRODUCT.raw_schema, ws.table_root("product_raw"))
    land_available(spark, drop, dims.PRODUCT_RAW, name, RUN2, checkpoint=f"{ws.root}/_stream_ckpt")
    return _out(spark.table(name).drop("source_file_name", "job_run_id"))


def _reordered_drop(ws: Workspace, tag: str) -> str:
    """Two sets of files of `part`, the second with its columns in reverse order and one more."""
    p, cols = ws.t("part"), list(dims.PRODUCT_RAW)
    path = ws.stage(_sel(p, S.product_exprs("new")), tag)
    twin = _sel(p, S.product_exprs("new_twin")).withColumn("EXTRA", F.lit("x"))
    return stage_csv(twin.select("EXTRA", *reversed(cols)), path, mode="append")


def q_stream_land_reordered(spark, sf):
    """The files of one micro-batch have their columns in different orders."""
    ws = Workspace(spark, sf)
    name = ws.name("product_raw")
    tb.create_table(spark, name, dims.PRODUCT.raw_schema, ws.table_root("product_raw"))
    land_available(spark, _reordered_drop(ws, "stream2"), dims.PRODUCT_RAW, name, RUN2, checkpoint=f"{ws.root}/_ckpt")
    return _out(spark.table(name).drop("source_file_name", "job_run_id"))


def _landed_once(spark, sf) -> tuple[Workspace, PipelineConfig]:
    """Layer 0 of the product dimension, three runs: a drop, the same drop again, the drop with new files."""
    ws, p, cfg = _pipeline(spark, sf, table_ids=("DIM_PRODUCT",), land_once=True)
    p.run_layer("DIM_PRODUCT", 0)
    p.run_layer("DIM_PRODUCT", 0)
    drop = specs.lookup(spark.table(cfg.metadata_table), "DIM_PRODUCT").source_table
    stage_csv(_sel(ws.t("part"), S.product_exprs("old")), drop, mode="append")
    p.run_layer("DIM_PRODUCT", 0)
    return ws, cfg


def q_land_rerun(spark, sf):
    """A repeated landing appends nothing; new files of the drop are landed once."""
    ws, _ = _landed_once(spark, sf)
    return _out(spark.table(ws.name("dim_product_raw")).drop("source_file_name", "job_run_id"))


def q_land_rerun_audit(spark, sf):
    _, cfg = _landed_once(spark, sf)
    return spark.table(cfg.audit_table).where("status = 'SUCCESS'").select(
        "layer", "records_read", "records_inserted", "records_updated", "records_rejected")


def _malformed_drop(ws: Workspace) -> str:
    """`part` as text lines: small parts lack the last field, large ones have one more."""
    cells = ["p_partkey", "p_brand", "p_size"]
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in cells])
    short = F.concat_ws(",", *[F.col(c).cast("string") for c in cells[:2]])
    text = F.when(F.col("p_size") <= 5, short).when(F.col("p_size") > 45, F.concat(line, F.lit(",extra"))).otherwise(line)
    path = f"{ws.root}/drop/malformed"
    # one column whose name is the header line; no separator or quote of its own
    ws.t("part").select(text.alias("P_ID,P_BRAND,P_SIZE")).write.option("header", "true").option("sep", "\x01").option(
        "quote", "").csv(path)
    return path


def _malformed_runs(spark, sf, stream: bool) -> tuple[Workspace, PipelineConfig]:
    """The same run of layer 0 twice over a drop with malformed lines."""
    ws = Workspace(spark, sf)
    meta = ws.name("ingestion_metadata")
    tb.create_table(spark, meta, specs.METADATA_SCHEMA, ws.table_root("meta"))
    publish(spark, specs.metadata_frame(spark, [{
        "table_id": "PARTS", "source_system": "FILE", "source_table": _malformed_drop(ws),
        "layer0_target_schema": ws.schema, "layer0_target_table": "parts_raw", "layer0_is_active": True,
        "layer0_script_path": "land_parts", "layer0_load_type": "APPEND"}]), meta, "APPEND")
    cfg = PipelineConfig(meta, ws.name("ingestion_audit_log"), f"{ws.root}/tables", stream_landing=stream)
    for _ in range(2):
        Pipeline(spark, cfg, RUN2).run_layer("PARTS", 0)
    return ws, cfg


_PARTS_RAW = T.StructType([T.StructField(c, T.StringType()) for c in ("P_ID", "P_BRAND", "P_SIZE")]
                          + [T.StructField("source_file_name", T.StringType()),
                             T.StructField("ingestion_timestamp", T.TimestampType()),
                             T.StructField("job_run_id", T.StringType())])


@register("land_parts", schema=lambda ctx: _PARTS_RAW)
def _land_parts(ctx: LayerContext) -> DataFrame:
    return land_source(ctx, ["P_ID", "P_BRAND", "P_SIZE"])


def _rejected_lines(ws: Workspace) -> DataFrame:
    return ws.spark.table(ws.name("parts_raw_rejects")).select(
        "raw_line", F.col("source_file_name").endswith(".csv").alias("from_csv_file"), "job_run_id",
        F.col("rejected_load_timestamp").cast("string").alias("rejected_load_timestamp"))


def q_quarantine_malformed(spark, sf):
    """Lines with too few or too many fields, with their file, once after two identical runs."""
    return _rejected_lines(_malformed_runs(spark, sf, stream=False)[0])


def q_quarantine_malformed_audit(spark, sf):
    """The rows that landed, per run's audit counts."""
    ws, cfg = _malformed_runs(spark, sf, stream=False)
    counts = spark.table(cfg.audit_table).where("status = 'SUCCESS'").select(
        "records_read", "records_inserted", "records_rejected")
    landed = spark.table(ws.name("parts_raw")).agg(F.count("*").alias("landed"), F.count("P_SIZE").alias("with_size")).first()
    return counts.withColumns({k: F.lit(v) for k, v in landed.asDict().items()})


def q_stream_quarantine_malformed(spark, sf):
    """As a stream: the second run sees no new file and rejects nothing more."""
    return _rejected_lines(_malformed_runs(spark, sf, stream=True)[0])


# ---------------------------------------------------------------- curation

def q_curate_product(spark, sf):
    return _out(_curated(ws := Workspace(spark, sf), dims.PRODUCT, product_raw(ws)))


def q_curate_customer(spark, sf):
    return _out(_curated(ws := Workspace(spark, sf), dims.CUSTOMER, customer_raw(ws)))


def q_curate_entities(spark, sf):
    return _out(_curated(ws := Workspace(spark, sf), dims.ENTITIES, entities_raw(ws)))


def q_quarantine_rejects(spark, sf):
    """Two identical runs: the reject table holds the run's raw text once."""
    ws, p, _ = _pipeline(spark, sf, table_ids=("DIM_PRODUCT",))
    p.run_table("DIM_PRODUCT")
    p.run_table("DIM_PRODUCT")
    return _out(spark.table(ws.name("dim_product_curated_rejects")))


def q_dedup_latest(spark, sf):
    ev = Workspace(spark, sf).t("events")
    return _out(dedup_latest(ev, ["user_id"], [("ts", "desc"), ("event_id", "desc")]))


def q_dedup_composite(spark, sf):
    li = Workspace(spark, sf).t("lineitem")
    return _out(dedup_latest(li, ["l_orderkey", "l_linenumber"], [("l_shipdate", "desc")]))


# ---------------------------------------------------------------- gold

def q_gold_product_path(spark, sf):
    ws = Workspace(spark, sf)
    d = dims.PRODUCT
    return _out(enrich(_curated(ws, d, product_raw(ws)), d.gold_rules, d.gold_order, RUN2))


def q_gold_customer_path(spark, sf):
    ws = Workspace(spark, sf)
    d = dims.CUSTOMER
    return _out(enrich(_curated(ws, d, customer_raw(ws)), d.gold_rules, d.gold_order, RUN2))


def q_gold_entities(spark, sf):
    ws = Workspace(spark, sf)
    d = dims.ENTITIES
    return _out(enrich(_curated(ws, d, entities_raw(ws)), d.gold_rules, d.gold_order, RUN2))


# ---------------------------------------------------------------- writes

def q_publish_append(spark, sf):
    ws = Workspace(spark, sf)
    o, name = ws.t("orders"), ws.name("orders_copy")
    publish(spark, o.filter(F.col("o_orderstatus") == "F"), name, "APPEND",
            root=ws.table_root("orders_copy"))
    publish(spark, o.filter(~(F.col("o_orderstatus") == "F") | F.col("o_orderstatus").isNull()),
            name, "APPEND")
    return _out(spark.table(name))


def q_merge_first_run(spark, sf):
    ws = Workspace(spark, sf)
    name = ws.name("supplier_copy")
    publish(spark, ws.t("supplier"), name, "MERGE", "s_suppkey", root=ws.table_root("supplier"))
    return spark.table(name)


def _customer_target_source(ws: Workspace):
    c = ws.t("customer")
    target = c.filter(F.col("c_acctbal") < 5000)
    source = c.filter(F.col("c_acctbal") >= 2500).withColumns({
        "c_name": F.concat("c_name", F.lit("*")), "c_acctbal": F.col("c_acctbal") + 1})
    return target, source


def _merged_customers(spark, sf, **opts):
    ws = Workspace(spark, sf)
    target, source = _customer_target_source(ws)
    name = ws.name("customer_t")
    publish(spark, target, name, "MERGE", "c_custkey", root=ws.table_root("customer_t"))
    res = publish(spark, source, name, "MERGE", "c_custkey", **opts)
    return spark.table(name), res


def _counts(spark, res) -> DataFrame:
    c = res.counts()
    return spark.createDataFrame(
        [(c["records_read"], c["records_inserted"], c["records_updated"])],
        "records_read bigint, records_inserted bigint, records_updated bigint")


def q_merge_upsert(spark, sf):
    return _merged_customers(spark, sf)[0]


def q_merge_upsert_broadcast(spark, sf):
    """A narrow source, merged straight from its plan: Spark broadcasts it by its own estimate."""
    return _merged_customers(spark, sf, narrow=True)[0]


def q_merge_metrics(spark, sf):
    return _counts(spark, _merged_customers(spark, sf)[1])


def q_merge_bucketed(spark, sf):
    """Target bucketed on the key by Spark's own CLUSTERED BY."""
    ws = Workspace(spark, sf)
    target, source = _customer_target_source(ws)
    name = ws.name("customer_b")
    publish(spark, target, name, "MERGE", "c_custkey", root=ws.table_root("customer_b"), buckets=8)
    publish(spark, source, name, "MERGE", "c_custkey")
    return spark.table(name)


def _repeated_target(spark, sf):
    """`lineitem` keyed by order alone (keys repeat), merged with one row per order: big orders are
    updated in every row, small ones come again under a new key."""
    ws = Workspace(spark, sf)
    li, name = ws.t("lineitem"), ws.name("lineitem_r")
    publish(spark, li, name, "MERGE", "l_orderkey", root=ws.table_root("lineitem_r"))
    per_order = li.groupBy("l_orderkey").agg(*[F.max(c).alias(c) for c in li.columns if c != "l_orderkey"])
    source = per_order.where("l_quantity >= 40").unionByName(
        per_order.where("l_quantity < 10").withColumn("l_orderkey", -F.col("l_orderkey")))
    return name, publish(spark, source, name, "MERGE", "l_orderkey")


def q_merge_repeated_target(spark, sf):
    return _out(spark.table(_repeated_target(spark, sf)[0]))


def q_merge_repeated_target_metrics(spark, sf):
    return _counts(spark, _repeated_target(spark, sf)[1])


def q_merge_composite_key(spark, sf):
    ws = Workspace(spark, sf)
    latest = dedup_latest(ws.t("lineitem"), ["l_orderkey", "l_linenumber"], [("l_shipdate", "desc")])
    target = latest.filter((F.col("l_returnflag") != "N") | (F.col("l_linestatus") == "F"))
    source = latest.filter(F.col("l_linestatus") == "O").withColumn(
        "l_quantity", F.col("l_quantity") + 1)
    name = ws.name("lineitem_t")
    keys = "l_orderkey, l_linenumber"
    publish(spark, target, name, "MERGE", keys, root=ws.table_root("lineitem_t"))
    publish(spark, source, name, "MERGE", keys)
    return _out(spark.table(name))


def _null_keyed(df: DataFrame, segment: str) -> DataFrame:
    return df.withColumn("c_custkey", F.when(F.col("c_mktsegment") == segment, F.lit(None))
                         .otherwise(F.col("c_custkey")))


def q_merge_null_key(spark, sf):
    ws = Workspace(spark, sf)
    target, source = _customer_target_source(ws)
    name = ws.name("customer_n")
    publish(spark, _null_keyed(target, "AUTOMOBILE"), name, "MERGE", "c_custkey",
            root=ws.table_root("customer_n"))
    publish(spark, _null_keyed(source, "BUILDING"), name, "MERGE", "c_custkey")
    return spark.table(name)


def q_merge_cardinality(spark, sf):
    """Orders merged as customers: most customers match several source rows.  The merge fails and the
    table stays as it was."""
    ws = Workspace(spark, sf)
    c, name = ws.t("customer").select("c_custkey", "c_name"), ws.name("customer_c")
    source = ws.t("orders").select(F.col("o_custkey").alias("c_custkey"), F.lit("changed").alias("c_name"))
    publish(spark, c, name, "MERGE", "c_custkey", root=ws.table_root("customer_c"))
    n = ambiguous_keys(spark.table(name), source, ["c_custkey"]).count()
    try:
        publish(spark, source, name, "MERGE", "c_custkey")
        raised = False
    except MergeCardinalityError:
        raised = True
    return spark.table(name).withColumns({"error_raised": F.lit(raised), "ambiguous_keys": F.lit(n).cast("long")})


def q_merge_unmatched_repeats(spark, sf):
    """Source keys that repeat but match no target row are all inserted."""
    ws = Workspace(spark, sf)
    c, name = ws.t("customer").select("c_custkey", "c_name"), ws.name("customer_x")
    publish(spark, c, name, "MERGE", "c_custkey", root=ws.table_root("customer_x"))
    new = ws.t("orders").select((-F.col("o_custkey") - 1).alias("c_custkey"), F.col("o_orderpriority").alias("c_name"))
    publish(spark, new.unionByName(c.withColumn("c_name", F.concat("c_name", F.lit("*")))), name, "MERGE", "c_custkey")
    return spark.table(name)


def q_merge_schema_fit(spark, sf):
    ws = Workspace(spark, sf)
    target, source = _customer_target_source(ws)
    name = ws.name("customer_f")
    publish(spark, target, name, "MERGE", "c_custkey", root=ws.table_root("customer_f"))
    publish(spark, source.withColumn("extra_col", F.lit("ignored")), name, "MERGE", "c_custkey")
    return spark.table(name)


def q_not_null_check(spark, sf):
    """A merge or append with NULL keys into a table whose key is NOT NULL fails; the table stays as it was."""
    ws = Workspace(spark, sf)
    c, name = ws.t("customer"), ws.name("customer_nn")
    required = T.StructType([T.StructField(f.name, f.dataType, f.name != "c_custkey") for f in c.schema.fields])
    publish(spark, c.where("c_custkey IS NOT NULL"), name, "MERGE", "c_custkey", schema=required,
            root=ws.table_root("customer_nn"))
    raised = []
    for load_type in ("MERGE", "APPEND"):
        try:
            publish(spark, _null_keyed(c, "AUTOMOBILE").withColumn("c_name", F.lit("changed")), name, load_type, "c_custkey")
        except Exception as e:
            raised += [load_type] if "NOT NULL" in str(e) else []
    return spark.table(name).withColumn("raised", F.lit(",".join(raised)))


def q_drop_recreate(spark, sf):
    """A dropped table is gone; the same name can be created again over another folder."""
    ws = Workspace(spark, sf)
    c, name = ws.t("customer"), ws.name("customer_d")
    publish(spark, c, name, "APPEND", root=ws.table_root("first"))
    tb.drop_table(spark, name)
    gone = not spark.catalog.tableExists(name)
    publish(spark, c.withColumn("c_name", F.lower("c_name")), name, "APPEND", root=ws.table_root("second"))
    return spark.table(name).withColumn("was_gone", F.lit(gone))


# ---------------------------------------------------------------- metadata

# One metadata row per `part` row (the table grows with the data).
def _metadata_rows(ws: Workspace) -> DataFrame:
    p = ws.t("part")
    rows = p.select(
        F.concat(F.lit("DIM_PART_"), F.col("p_partkey").cast("string")).alias("table_id"),
        F.lit("FILE").alias("source_system"),
        F.concat(F.lit("/drop/"), F.col("p_name"), F.lit(".csv")).alias("source_table"),
        F.when(F.col("p_size") > 25, F.lit("FACT")).otherwise(F.lit("DIMENSION")).alias("table_group"),
        F.when(F.col("p_size") <= 10, F.lit(None)).otherwise(F.col("p_size") % 3 != 0)
         .alias("table_is_active"),
        F.lit("MERGE").alias("layer1_load_type"),
        F.col("p_brand").alias("layer1_target_table"),
    )
    return tb.aligned(rows.select(*[F.col(c) for c in rows.columns],
                                  *[F.lit(None).cast(f.dataType).alias(f.name)
                                    for f in specs.METADATA_SCHEMA.fields
                                    if f.name not in rows.columns]),
                      specs.METADATA_SCHEMA)


def _metadata_table(spark, sf) -> tuple[Workspace, str]:
    ws = Workspace(spark, sf)
    name = ws.name("ingestion_metadata")
    tb.create_table(spark, name, specs.METADATA_SCHEMA, ws.table_root("meta"))
    publish(spark, _metadata_rows(ws), name, "APPEND")
    return ws, name


def q_insert_values(spark, sf):
    _, name = _metadata_table(spark, sf)
    return spark.table(name).select("table_id", "source_system", "source_table", "table_group",
                                    "table_is_active", "layer1_load_type", "layer1_target_table",
                                    "layer0_target_table")


def q_metadata_lookup(spark, sf):
    _, name = _metadata_table(spark, sf)
    return specs.metadata_row(spark.table(name), "DIM_PART_7").select(
        "table_id", "source_table", "table_group", "table_is_active")


def q_active_tables(spark, sf):
    _, name = _metadata_table(spark, sf)
    return specs.active_tables(spark.table(name))


def q_active_tables_group(spark, sf):
    _, name = _metadata_table(spark, sf)
    return specs.active_tables(spark.table(name), "DIMENSION")


def _orders_table(spark, sf) -> tuple[Workspace, str]:
    ws = Workspace(spark, sf)
    name = ws.name("orders_u")
    publish(spark, ws.t("orders"), name, "APPEND", root=ws.table_root("orders_u"))
    return ws, name


def q_update_where(spark, sf):
    _, name = _orders_table(spark, sf)
    update_table(spark, name, {"o_orderpriority": F.lit("0-URGENT")}, F.col("o_orderstatus") == "P")
    return _out(spark.table(name))


def q_update_all(spark, sf):
    _, name = _orders_table(spark, sf)
    update_table(spark, name, {"o_orderpriority": F.lit("10")})
    return _out(spark.table(name))


def q_update_in_list(spark, sf):
    _, name = _orders_table(spark, sf)
    update_table(spark, name, {"o_orderstatus": F.lit("X")},
                 F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return _out(spark.table(name))


def q_add_column_backfill(spark, sf):
    ws = Workspace(spark, sf)
    c, name = ws.t("customer"), ws.name("customer_g")
    publish(spark, c.filter(F.col("c_mktsegment") != "MACHINERY"), name, "APPEND",
            root=ws.table_root("customer_g"))
    tb.add_column(spark, name, "table_group", "string", "DIMENSION or FACT")
    publish(spark, c.filter(F.col("c_mktsegment") == "MACHINERY")
            .withColumn("table_group", F.lit("FACT")), name, "APPEND")
    add_column_with_backfill(spark, name, "table_group", "string", "DIMENSION")
    return spark.table(name)


def q_create_schema(spark, sf):
    """A schema with a comment and a place of its own, created twice; the regions in a table of it, with what the
    catalog says of the schema."""
    ws = Workspace(spark, sf)
    name, place = f"{ws.schema}_own", f"{ws.root}/own_schema"
    for comment in ("it's ours", "not set again"):
        tb.create_schema(spark, name, comment, place)
    publish(spark, ws.t("region"), f"{name}.regions", "APPEND", root=f"{place}/regions")
    said = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE SCHEMA {name}").collect()}
    return spark.table(f"{name}.regions").withColumns({
        "comment": F.lit(said["Comment"]), "in_place": F.lit(said["Location"].endswith("/own_schema")),
        "tables": F.lit(spark.sql(f"SHOW TABLES IN {name}").count()).cast("long")})


def q_create_target(spark, sf):
    """Declared curated schema (NOT NULL key, DECIMAL, INT, BOOLEAN) created
    first, then filled from the curated rows."""
    ws = Workspace(spark, sf)
    d = dims.PRODUCT
    name = ws.name("dim_product_curated")
    tb.create_table(spark, name, d.curated_schema, ws.table_root("cur"), comment="curated product")
    publish(spark, _curated(ws, d, product_raw(ws)), name, "MERGE", d.key)
    return _out(spark.table(name))


# Metadata-driven rules over `part` landed as product.
PRODUCT_MAPPING = ('{"PRODUCT_ID": "product_id", "DESCRIPTION": "description", '
                   '"BRAND": "brand", "PACK": "pack", "GAS_EXCHANGE": "gas_exchange"}')
PRODUCT_RULES_JSON = ('[{"target": "pack", "source": "PACK", "rule": "cast", "type": "decimal(18,5)"},'
                      ' {"target": "gas_exchange", "source": "GAS_EXCHANGE", "rule": "flag"},'
                      ' {"target": "brand_upper", "source": "BRAND", "rule": "upper"},'
                      ' {"target": "qty", "source": "CYLINDER_QTY", "rule": "cast", "type": "int"}]')


# A metadata rule of the gold layer.
PRODUCT_GOLD_JSON = '[{"target": "label", "rule": "path", "columns": ["brand", "description"]}]'


def _by_metadata(spark, sf, rules: str | None, layers=(1,), gold: str | None = None) -> tuple[Workspace, str]:
    """The product raw table run through the rule transforms that its metadata row names."""
    ws = Workspace(spark, sf)
    publish(spark, product_raw(ws), ws.name("product_raw"), "APPEND", root=ws.table_root("product_raw"))
    meta = ws.name("ingestion_metadata")
    tb.create_table(spark, meta, specs.METADATA_SCHEMA, ws.table_root("meta"))
    row = {"table_id": "PRODUCT", "source_system": "FILE", "reporting_unit_id": "RU-7",
           "layer1_script_path": "curate_rules", "layer2_script_path": "gold_rules",
           "layer1_column_mapping": PRODUCT_MAPPING, "layer1_transformation_rules": rules,
           "layer2_transformation_rules": gold}
    for n, name in enumerate(("product_raw", "product_curated", "product_gold")):
        row.update({f"layer{n}_target_schema": ws.schema, f"layer{n}_target_table": name, f"layer{n}_is_active": True,
                    f"layer{n}_load_type": "MERGE" if n else "APPEND"})
        if n:
            row[f"layer{n}_merge_keys"] = "product_id"
    publish(spark, specs.metadata_frame(spark, [row]), meta, "APPEND")
    cfg = PipelineConfig(meta, ws.name("ingestion_audit_log"), f"{ws.root}/tables")
    Pipeline(spark, cfg, RUN2).run_table("PRODUCT", layers)
    return ws, cfg.audit_table


def q_column_mapping(spark, sf):
    return _out(spark.table(_by_metadata(spark, sf, None)[0].name("product_curated")))


def q_transformation_rules(spark, sf):
    return _out(spark.table(_by_metadata(spark, sf, PRODUCT_RULES_JSON)[0].name("product_curated")))


def q_gold_by_metadata(spark, sf):
    ws, _ = _by_metadata(spark, sf, PRODUCT_RULES_JSON, (1, 2), PRODUCT_GOLD_JSON)
    return _out(spark.table(ws.name("product_gold")))


def q_audit_fields(spark, sf):
    """The audit columns a run fills: user, reporting unit, states and counts."""
    _, audit = _by_metadata(spark, sf, PRODUCT_RULES_JSON, (1, 2), PRODUCT_GOLD_JSON)
    return au.latest_state(spark.table(audit)).select(
        "job_run_id", "table_name", "layer", "reporting_unit_id", "status", "records_read", "records_inserted",
        "records_updated", "records_rejected", (F.col("executed_by") == F.current_user()).alias("by_session_user"),
        (F.col("end_time") >= F.col("start_time")).alias("ends_after_start"), "error_message")


@register("orders_open_value")
def _orders_open_value(ctx: LayerContext) -> DataFrame:
    """Example custom transform: open orders with a value band."""
    o = ctx.upstream()
    return o.filter(F.col("o_orderstatus") == "O").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.when(F.col("o_totalprice") >= 200000, "HIGH").otherwise("LOW").alias("value_band"))


def q_custom_transform(spark, sf):
    ws, name = _orders_table(spark, sf)
    meta = ws.name("ingestion_metadata")
    tb.create_table(spark, meta, specs.METADATA_SCHEMA, ws.table_root("meta"))
    publish(spark, specs.metadata_frame(spark, [{
        "table_id": "ORDERS", "layer0_target_schema": ws.schema, "layer0_target_table": name.split(".")[1],
        "layer1_target_schema": ws.schema, "layer1_target_table": "orders_open", "layer1_is_active": True,
        "layer1_script_path": "orders_open_value", "layer1_load_type": "MERGE", "layer1_merge_keys": "o_orderkey"}]),
        meta, "APPEND")
    cfg = PipelineConfig(meta, ws.name("ingestion_audit_log"), f"{ws.root}/tables")
    Pipeline(spark, cfg, RUN2).run_layer("ORDERS", 1)
    return spark.table(ws.name("orders_open"))


def _two_arrivals(ws: Workspace, first: DataFrame, every: DataFrame, column: str, keys, order,
                  data_type: str | None = None) -> DataFrame:
    """A source read twice by its business watermark into a raw history, then curated: the latest row
    per key, among all rows so far of the keys in the second batch."""
    spark, raw, cur = ws.spark, ws.name("raw"), ws.name("cur")
    token = None
    for n, source in enumerate((first, every)):
        batch, token = source_batch(source, column, token, data_type)
        batch = batch.withColumn("load_no", F.lit(n))
        publish(spark, batch, raw, "APPEND", root=ws.table_root("raw"))
        new = spark.table(raw).where(F.col("load_no") == n)
        latest = dedup_latest(history_of(new, spark.table(raw), {k: F.col(k) for k in keys}).drop("load_no"), keys, order)
        publish(spark, latest, cur, "MERGE", keys, root=ws.table_root("cur"))
    return _out(spark.table(cur))


def q_incremental_null_watermark(spark, sf):
    """Latest event per user by time; some events have no time and must neither be lost nor win."""
    ws = Workspace(spark, sf)
    ev = ws.t("events").withColumn("ts", F.when(F.col("event_type") != "purchase", F.col("ts")))
    first = ev.where(F.col("ts").isNull() | (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
    return _two_arrivals(ws, first, ev, "ts", ["user_id"], [("ts", "desc"), ("event_id", "desc")])


def q_incremental_ties(spark, sf):
    """Orders by date: the second arrival has rows of the first one's last day."""
    ws = Workspace(spark, sf)
    o = ws.t("orders")
    last = F.lit("1997-06-30").cast(o.schema["o_orderdate"].dataType)
    first = o.where((F.col("o_orderdate") < last) | ((F.col("o_orderdate") == last) & (F.col("o_orderstatus") == "F")))
    return _two_arrivals(ws, first, o, "o_orderdate", ["o_orderkey"], [("o_orderdate", "desc")])


def q_incremental_numeric_text(spark, sf):
    """Orders with their key as text: as a number 9 comes before 11."""
    ws = Workspace(spark, sf)
    o = ws.t("orders").withColumn("seq", F.col("o_orderkey").cast("string"))
    first = o.where(F.col("o_orderkey") < 900)
    return _two_arrivals(ws, first, o, "seq", ["o_orderkey"], [("o_orderdate", "desc")], "bigint")


def q_incremental_late(spark, sf):
    """Orders by date in two arrivals.  Urgent orders are late: the second run reads those of the last 60
    days before its watermark, and counts the older ones, which it leaves."""
    ws = Workspace(spark, sf)
    o, name = ws.t("orders"), ws.name("orders_raw")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    first = o.where(~urgent & (F.col("o_orderdate") <= F.lit("1997-06-30").cast(o.schema["o_orderdate"].dataType)))
    batch, token = source_batch(first, "o_orderdate")
    publish(spark, batch, name, "APPEND", root=ws.table_root("orders_raw"))
    missed = too_late(o, spark.table(name), "o_orderdate", token, "60 days").count()
    batch, _ = late_batch(o, spark.table(name), "o_orderdate", token, "60 days")
    publish(spark, batch, name, "APPEND")
    return _out(spark.table(name).withColumn("too_late", F.lit(missed)))


def _event_arrivals(ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """Events by day, in two arrivals: views come last, whatever their time; purchases have no time."""
    ev = ws.t("events").withColumn("ts", F.when(F.col("event_type") != "purchase", F.date_trunc("day", "ts")))
    late = F.col("event_type") == "view"
    return ev.where(~late), ev.where(late)


def _merged_if_newer(spark, sf):
    ws = Workspace(spark, sf)
    name = ws.name("latest_event")
    for rows in _event_arrivals(ws):
        res = publish(spark, rows, name, "MERGE", ["user_id"], root=ws.table_root("latest_event"),
                      newer_by=["ts", "event_id"])
    return spark.table(name), res


def _range_merged(spark, sf):
    """Orders in ranges of a tenth of the table: a first load of the lower nine tenths of the keys, then a batch of
    changed and new orders in the upper fifth."""
    ws = Workspace(spark, sf)
    o, name = ws.t("orders"), ws.name("orders_by_range")
    top, n = o.agg(F.max("o_orderkey"), F.count("*")).first()
    publish(spark, o.where(F.col("o_orderkey") <= 0.9 * top), name, "MERGE", "o_orderkey",
            root=ws.table_root("orders_by_range"), range_rows=max(1, n // 10))
    before = {r[0] for r in live_ranges(spark, name)}
    batch = o.where(F.col("o_orderkey") > 0.8 * top).withColumn("o_orderpriority", F.lit("0-NOW"))
    res = publish(spark, batch, name, "MERGE", "o_orderkey")
    kept = before & {r[0] for r in live_ranges(spark, name)}
    return ws, name, res, len(kept) * 2 > len(before)


def q_merge_range_pruned(spark, sf):
    """The rows after the batch; most ranges are the ones written by the first load."""
    _, name, _, kept = _range_merged(spark, sf)
    return _out(spark.table(name).withColumn("most_ranges_kept", F.lit(kept)))


def q_merge_range_metrics(spark, sf):
    return _counts(spark, _range_merged(spark, sf)[2])


def q_update_range_pruned(spark, sf):
    """An UPDATE of the orders of the lowest keys, then the expiry of what it replaced."""
    ws, name, _, _ = _range_merged(spark, sf)
    low = ws.t("orders").agg(F.min("o_orderkey")).first()[0] + 100
    before = {r[0] for r in live_ranges(spark, name)}
    update_table(spark, name, {"o_orderstatus": F.lit("X")}, F.col("o_orderkey") < low)
    gone = before - {r[0] for r in live_ranges(spark, name)}
    expire_ranges(spark, name, 0)
    return _out(spark.table(name).withColumn("ranges_rewritten", F.lit(len(gone)).cast("long")))


def q_merge_if_newer(spark, sf):
    """The latest event per user, kept by a conditional MERGE: ties on the day, NULL times, and older events
    that arrive after newer ones."""
    return _out(_merged_if_newer(spark, sf)[0])


def q_merge_if_newer_metrics(spark, sf):
    return _counts(spark, _merged_if_newer(spark, sf)[1])


@register("latest_event", newer_by=["ts", "event_id"])
def _latest_event(ctx: LayerContext) -> DataFrame:
    """The newly landed events; the MERGE keeps the latest per user."""
    return ctx.upstream().drop(*LINEAGE_COLUMNS)


def q_run_if_newer(spark, sf):
    """Two incremental runs of a layer whose order is the event's own time, not the load time."""
    ws = Workspace(spark, sf)
    meta, raw = ws.name("ingestion_metadata"), ws.name("events_raw")
    tb.create_table(spark, meta, specs.METADATA_SCHEMA, ws.table_root("meta"))
    publish(spark, specs.metadata_frame(spark, [{
        "table_id": "EVENTS", "source_system": "FILE", "source_table": "-", "watermark_column": LINEAGE_COLUMNS[1],
        "layer0_target_schema": ws.schema, "layer0_target_table": "events_raw",
        "layer1_target_schema": ws.schema, "layer1_target_table": "latest_event", "layer1_is_active": True,
        "layer1_script_path": "latest_event", "layer1_load_type": "MERGE", "layer1_merge_keys": "user_id"}]),
        meta, "APPEND")
    cfg = PipelineConfig(meta, ws.name("ingestion_audit_log"), f"{ws.root}/tables")
    for run, rows in zip((RUN1, RUN2), _event_arrivals(ws)):
        publish(spark, with_lineage(rows, run, source_name="events"), raw, "APPEND", root=ws.table_root("events_raw"))
        Pipeline(spark, cfg, run).run_layer("EVENTS", 1)
    return _out(spark.table(ws.name("latest_event")))


def q_incremental_read(spark, sf):
    ws = Workspace(spark, sf)
    ev, name = ws.t("events"), ws.name("events_t")
    publish(spark, ev.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")), name,
            "APPEND", root=ws.table_root("events_t"))
    return _out(incremental_read(ev, "ts", high_watermark(spark.table(name), "ts")))


def q_append_compacts(spark, sf):
    """Orders by status, appended in one go for the pending ones and priority by priority for the others: the
    partitions with several small files are packed, the pending one's file stays."""
    ws = Workspace(spark, sf)
    o, name = ws.t("orders"), ws.name("orders_small")
    publish(spark, o.where("o_orderstatus = 'P'"), name, "APPEND", root=ws.table_root("orders_small"),
            partition_by=["o_orderstatus"])
    rest = o.where("o_orderstatus <> 'P'")
    for (priority,) in rest.select("o_orderpriority").distinct().orderBy("o_orderpriority").collect():
        publish(spark, rest.where(F.col("o_orderpriority") == priority), name, "APPEND")
    before = spark.table(name).inputFiles()
    packed = compact_appends(spark, name, AutoCompact(min_files=4))
    after = spark.table(name).inputFiles()
    kept = {f for f in before if "o_orderstatus=P" in f} == set(before) & set(after)
    return _out(spark.table(name).withColumns({
        "packed": F.lit(packed), "fewer": F.lit(len(after) < len(before)), "others_kept": F.lit(kept)}))


def q_partitioned_write(spark, sf):
    ws = Workspace(spark, sf)
    o, name = ws.t("orders"), ws.name("orders_p")
    schema = tb.aligned(o, o.schema).schema
    tb.create_table(spark, name, schema, ws.table_root("orders_p"), partition_by=["o_orderstatus"])
    publish(spark, o, name, "APPEND")
    return _out(spark.table(name).filter(F.col("o_orderstatus") == "O"))


def q_merge_partitioned(spark, sf):
    """Target partitioned by a key column: the merge of the changed 'P'
    orders reads, rewrites and switches only partition P."""
    ws = Workspace(spark, sf)
    o, name = ws.t("orders"), ws.name("orders_mp")
    tb.create_table(spark, name, o.schema, ws.table_root("orders_mp"), partition_by=["o_orderstatus"])
    publish(spark, o, name, "APPEND")
    changed = o.filter(F.col("o_orderstatus") == "P").withColumn("o_orderpriority", F.lit("0-NOW"))
    publish(spark, changed, name, "MERGE", ["o_orderstatus", "o_orderkey"])
    return _out(spark.table(name))


def q_merge_partition_moves(spark, sf):
    """Target partitioned by segment, keyed by customer: the merge moves
    every HOUSEHOLD customer to a new segment (that partition empties and is
    dropped) and renames rich AUTOMOBILE customers; other partitions are
    not rewritten."""
    ws = Workspace(spark, sf)
    c, name = ws.t("customer"), ws.name("customer_mp")
    tb.create_table(spark, name, c.schema, ws.table_root("customer_mp"), partition_by=["c_mktsegment"])
    publish(spark, c, name, "APPEND")
    moved = c.filter(F.col("c_mktsegment") == "HOUSEHOLD").withColumn("c_mktsegment", F.lit("X/new"))
    renamed = c.filter((F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_acctbal") > 5000)) \
        .withColumn("c_name", F.lit("changed"))
    publish(spark, moved.unionByName(renamed), name, "MERGE", "c_custkey")
    return _out(spark.table(name))


def q_update_partitioned(spark, sf):
    """UPDATE on a table partitioned by status: the matching rows sit in
    partition P, so only P is rewritten and switched."""
    ws = Workspace(spark, sf)
    o, name = ws.t("orders"), ws.name("orders_up")
    tb.create_table(spark, name, o.schema, ws.table_root("orders_up"), partition_by=["o_orderstatus"])
    publish(spark, o, name, "APPEND")
    update_table(spark, name, {"o_orderpriority": F.lit("0-URGENT")}, F.col("o_orderstatus") == "P")
    return _out(spark.table(name))


def _blank_statuses(ws: Workspace) -> DataFrame:
    """Orders of which some have no status and some an empty one."""
    return ws.t("orders").withColumn(
        "o_orderstatus", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("")).otherwise(F.col("o_orderstatus")))


def q_merge_partition_null(spark, sf):
    """A merge that moves rows into the partition of NULL and empty values: its other rows stay."""
    ws = Workspace(spark, sf)
    o, name = _blank_statuses(ws), ws.name("orders_pn")
    tb.create_table(spark, name, o.schema, ws.table_root("orders_pn"), partition_by=["o_orderstatus"])
    publish(spark, o, name, "APPEND")
    moved = o.where("o_orderpriority = '3-MEDIUM'").withColumn("o_orderstatus", F.lit(""))
    new = o.where("o_orderpriority = '5-LOW'").withColumns(
        {"o_orderkey": -F.col("o_orderkey") - 1, "o_orderstatus": F.lit(None).cast("string")})
    publish(spark, moved.unionByName(new), name, "MERGE", "o_orderkey")
    return _out(spark.table(name))


def q_update_partition_blank(spark, sf):
    ws = Workspace(spark, sf)
    o, name = _blank_statuses(ws), ws.name("orders_ub")
    tb.create_table(spark, name, o.schema, ws.table_root("orders_ub"), partition_by=["o_orderstatus"])
    publish(spark, o, name, "APPEND")
    update_table(spark, name, {"o_orderstatus": F.lit("")}, F.col("o_orderstatus") == "P")
    update_table(spark, name, {"o_orderpriority": F.lit("none")}, F.col("o_orderstatus").isNull())
    return _out(spark.table(name))


# ---------------------------------------------------------------- runs

# Metadata rows for the three dimensions.
def _dimension_metadata(ws: Workspace, sources: dict[str, str], active=(True, True, True),
                        table_ids=("DIM_PRODUCT", "DIM_CUSTOMER", "DIM_ENTITIES")) -> list[dict]:
    out = []
    for tid in table_ids:
        d = dims.DIMENSIONS[tid.lower()]
        row = {"table_id": tid, "source_system": "FILE", "source_schema": "source_files",
               "source_table": sources[tid], "table_group": "DIMENSION"}
        for n, (schema, suffix) in enumerate((("raw", "raw"), ("curated", "curated"), ("gold", "gold"))):
            row.update({f"layer{n}_target_schema": f"{ws.schema}",
                        f"layer{n}_target_table": f"{d.name}_{suffix}",
                        f"layer{n}_script_path": f"{d.name}.l{n}",
                        f"layer{n}_load_type": "APPEND" if n == 0 else "MERGE",
                        f"layer{n}_is_active": active[n]})
            if n:
                row[f"layer{n}_merge_keys"] = d.key
        out.append(row)
    return out


def _drops(ws: Workspace, ids=("DIM_PRODUCT", "DIM_CUSTOMER", "DIM_ENTITIES")) -> dict[str, str]:
    """Stage the landing CSV of each requested dimension."""
    make = {
        "DIM_PRODUCT": lambda: ws.stage(_sel(ws.t("part"), S.product_exprs("new")).unionByName(
            _sel(ws.t("part"), S.product_exprs("new_twin"))), "p"),
        "DIM_CUSTOMER": lambda: ws.stage(_sel(_customer_src(ws), S.customer_exprs("new")), "c"),
        "DIM_ENTITIES": lambda: ws.stage(_sel(ws.t("supplier"), S.ENTITIES), "e"),
    }
    return {i: make[i]() for i in ids}


def _pipeline(spark, sf, active=(True, True, True), table_ids=None, **options):
    ws = Workspace(spark, sf)
    ids = table_ids or ("DIM_PRODUCT", "DIM_CUSTOMER", "DIM_ENTITIES")
    drops = _drops(ws, ids)
    meta = ws.name("ingestion_metadata")
    tb.create_table(spark, meta, specs.METADATA_SCHEMA, ws.table_root("meta"))
    publish(spark, specs.metadata_frame(spark, _dimension_metadata(ws, drops, active, ids)),
            meta, "APPEND")
    cfg = PipelineConfig(meta, ws.name("ingestion_audit_log"), f"{ws.root}/tables", **options)
    return ws, Pipeline(spark, cfg, RUN2), cfg


def q_run_table(spark, sf):
    ws, p, _ = _pipeline(spark, sf, table_ids=("DIM_PRODUCT",))
    p.run_table("DIM_PRODUCT")
    return _out(spark.table(ws.name("dim_product_gold")))


def q_run_table_bucketed(spark, sf):
    """Two runs with bucketed curated and gold tables; the second run's
    merges are co-located."""
    ws, p, _ = _pipeline(spark, sf, table_ids=("DIM_PRODUCT",), buckets=8)
    p.run_table("DIM_PRODUCT")
    p.run_table("DIM_PRODUCT")
    return _out(spark.table(ws.name("dim_product_gold")))


def incremental_runs(spark, sf, incremental=True, stream=False):
    """Customer dimension in two runs: run 1 lands every customer, run 2
    only the changed ones (balance above 5000).  With a watermark column
    in the metadata, run 2's curation and gold layers read only the rows
    landed after run 1.  ``stream``: the changed rows arrive as new files in
    the same drop folder, and layer 0 lands only those files."""
    ws = Workspace(spark, sf)
    c = _customer_src(ws)
    drop1 = ws.stage(_sel(c, S.customer_exprs("old")), "c1")
    changed = _sel(c.filter(F.col("c_acctbal") > 5000), S.customer_exprs("new"))
    meta = ws.name("ingestion_metadata")
    tb.create_table(spark, meta, specs.METADATA_SCHEMA, ws.table_root("meta"))
    rows = _dimension_metadata(ws, {"DIM_CUSTOMER": drop1}, table_ids=("DIM_CUSTOMER",))
    if incremental:
        rows[0]["watermark_column"] = "ingestion_timestamp"
    publish(spark, specs.metadata_frame(spark, rows), meta, "APPEND")
    cfg = PipelineConfig(meta, ws.name("ingestion_audit_log"), f"{ws.root}/tables",
                         stream_landing=stream)
    Pipeline(spark, cfg, RUN1).run_table("DIM_CUSTOMER")
    if stream:
        stage_csv(changed, drop1, mode="append")
    else:
        drop2 = ws.stage(changed, "c2")
        update_table(spark, meta, {"source_table": F.lit(drop2)}, F.col("table_id") == "DIM_CUSTOMER")
    Pipeline(spark, cfg, RUN2).run_table("DIM_CUSTOMER")
    return ws, cfg


def q_run_incremental(spark, sf):
    ws, _ = incremental_runs(spark, sf)
    return _out(spark.table(ws.name("dim_customer_gold")))


def q_run_incremental_audit(spark, sf):
    _, cfg = incremental_runs(spark, sf)
    return au.latest_state(spark.table(cfg.audit_table)).select(
        "job_run_id", "layer", "records_read", "records_inserted", "records_updated",
        "records_rejected")


def q_run_stream_landing(spark, sf):
    ws, _ = incremental_runs(spark, sf, stream=True)
    return _out(spark.table(ws.name("dim_customer_gold")))


def q_run_stream_landing_audit(spark, sf):
    _, cfg = incremental_runs(spark, sf, stream=True)
    return au.latest_state(spark.table(cfg.audit_table)).select(
        "job_run_id", "layer", "records_read", "records_inserted", "records_updated",
        "records_rejected")


def q_run_layer(spark, sf):
    ws, p, _ = _pipeline(spark, sf, table_ids=("DIM_CUSTOMER",))
    p.run_layer("DIM_CUSTOMER", 0)
    p.run_layer("DIM_CUSTOMER", 1)
    return _out(spark.table(ws.name("dim_customer_curated")))


def q_run_layer_skip(spark, sf):
    ws, p, cfg = _pipeline(spark, sf, active=(True, False, True), table_ids=("DIM_ENTITIES",))
    p.run_table("DIM_ENTITIES")
    st = au.latest_state(spark.table(cfg.audit_table))
    return st.select("table_name", "layer", "status", "records_read", "records_inserted",
                     "records_updated", "records_rejected")


def q_run_active(spark, sf):
    ws, p, cfg = _pipeline(spark, sf)
    p.run_active(max_parallel=3)
    return au.latest_state(spark.table(cfg.audit_table)).select(
        "table_name", "layer", "status", "records_read", "records_inserted",
        "records_updated", "records_rejected")


def q_audit_buffered(spark, sf):
    """As ``run_active``, with the events of the run in one file of a log by day, read by day."""
    ws, p, cfg = _pipeline(spark, sf, buffered_audit=True)
    today = dt.datetime.now(UTC).date()
    p.run_active(max_parallel=3)
    log = spark.table(cfg.audit_table)
    files = len(log.inputFiles())
    state = au.latest_state(log, today - dt.timedelta(days=1), today + dt.timedelta(days=1))
    return state.select("table_name", "layer", "status", "records_read", "records_inserted", "records_updated",
                        "records_rejected", F.lit(files <= 2).alias("few_files"))


def q_run_active_failure(spark, sf):
    """Three active tables, one of which names a missing transform: the others run, the failure is
    audited, then raised."""
    ws, p, cfg = _pipeline(spark, sf)
    update_table(spark, cfg.metadata_table, {"layer1_script_path": F.lit("missing.l1")},
                 F.col("table_id") == "DIM_CUSTOMER")
    try:
        p.run_active(max_parallel=3)
        failed = ""
    except RunFailed as e:
        failed = ",".join(sorted(e.errors))
    return au.latest_state(spark.table(cfg.audit_table)).select(
        "table_name", "layer", "status", "records_read", "error_message", F.lit(failed).alias("failed"))


def q_audit_compact(spark, sf):
    ws, p, cfg = _pipeline(spark, sf, table_ids=("DIM_ENTITIES",))
    p.run_table("DIM_ENTITIES")
    before = len(spark.table(cfg.audit_table).inputFiles())
    au.compact(spark, cfg.audit_table)
    ev = spark.table(cfg.audit_table)
    fewer = len(ev.inputFiles()) < before
    return au.latest_state(ev).select("table_name", "layer", "status", "records_read", F.lit(fewer).alias("fewer_files"))


def q_audit_lifecycle(spark, sf):
    """Two runs of the product pipeline: the second one's gold and curated
    merges are all updates."""
    ws, p, cfg = _pipeline(spark, sf, table_ids=("DIM_PRODUCT",))
    p.run_table("DIM_PRODUCT")
    p.run_table("DIM_PRODUCT")
    ev = spark.table(cfg.audit_table)
    return au.latest_state(ev).groupBy("table_name", "layer", "status", "records_read",
                                       "records_inserted", "records_updated",
                                       "records_rejected").agg(F.count(F.lit(1)).alias("runs"))


QUERIES = {
    "land_csv": q_land_csv,
    "land_lineage": q_land_lineage,
    "land_csv_reordered": q_land_csv_reordered,
    "table_scan": q_table_scan,
    "stream_land": q_stream_land,
    "curate_product": q_curate_product,
    "curate_customer": q_curate_customer,
    "curate_entities": q_curate_entities,
    "land_rerun": q_land_rerun,
    "land_rerun_audit": q_land_rerun_audit,
    "stream_land_reordered": q_stream_land_reordered,
    "quarantine_malformed": q_quarantine_malformed,
    "quarantine_malformed_audit": q_quarantine_malformed_audit,
    "stream_quarantine_malformed": q_stream_quarantine_malformed,
    "quarantine_rejects": q_quarantine_rejects,
    "dedup_latest": q_dedup_latest,
    "dedup_composite": q_dedup_composite,
    "gold_product_path": q_gold_product_path,
    "gold_customer_path": q_gold_customer_path,
    "gold_entities": q_gold_entities,
    "publish_append": q_publish_append,
    "merge_first_run": q_merge_first_run,
    "merge_upsert": q_merge_upsert,
    "merge_upsert_broadcast": q_merge_upsert_broadcast,
    "merge_metrics": q_merge_metrics,
    "merge_bucketed": q_merge_bucketed,
    "merge_repeated_target": q_merge_repeated_target,
    "merge_repeated_target_metrics": q_merge_repeated_target_metrics,
    "merge_unmatched_repeats": q_merge_unmatched_repeats,
    "merge_partition_null": q_merge_partition_null,
    "update_partition_blank": q_update_partition_blank,
    "drop_recreate": q_drop_recreate,
    "gold_by_metadata": q_gold_by_metadata,
    "audit_fields": q_audit_fields,
    "audit_compact": q_audit_compact,
    "incremental_null_watermark": q_incremental_null_watermark,
    "incremental_ties": q_incremental_ties,
    "incremental_numeric_text": q_incremental_numeric_text,
    "run_active_failure": q_run_active_failure,
    "merge_composite_key": q_merge_composite_key,
    "merge_null_key": q_merge_null_key,
    "merge_cardinality": q_merge_cardinality,
    "merge_schema_fit": q_merge_schema_fit,
    "not_null_check": q_not_null_check,
    "insert_values": q_insert_values,
    "metadata_lookup": q_metadata_lookup,
    "active_tables": q_active_tables,
    "active_tables_group": q_active_tables_group,
    "update_where": q_update_where,
    "update_all": q_update_all,
    "update_in_list": q_update_in_list,
    "add_column_backfill": q_add_column_backfill,
    "create_schema": q_create_schema,
    "create_target": q_create_target,
    "column_mapping": q_column_mapping,
    "transformation_rules": q_transformation_rules,
    "custom_transform": q_custom_transform,
    "incremental_read": q_incremental_read,
    "append_compacts": q_append_compacts,
    "partitioned_write": q_partitioned_write,
    "merge_partitioned": q_merge_partitioned,
    "update_partitioned": q_update_partitioned,
    "merge_partition_moves": q_merge_partition_moves,
    "run_table": q_run_table,
    "run_table_bucketed": q_run_table_bucketed,
    "incremental_late": q_incremental_late,
    "merge_range_pruned": q_merge_range_pruned,
    "merge_range_metrics": q_merge_range_metrics,
    "update_range_pruned": q_update_range_pruned,
    "merge_if_newer": q_merge_if_newer,
    "merge_if_newer_metrics": q_merge_if_newer_metrics,
    "run_if_newer": q_run_if_newer,
    "run_incremental": q_run_incremental,
    "run_incremental_audit": q_run_incremental_audit,
    "run_stream_landing": q_run_stream_landing,
    "run_stream_landing_audit": q_run_stream_landing_audit,
    "run_layer": q_run_layer,
    "run_layer_skip": q_run_layer_skip,
    "run_active": q_run_active,
    "audit_lifecycle": q_audit_lifecycle,
    "audit_buffered": q_audit_buffered,
}
