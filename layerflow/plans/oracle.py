"""DuckDB SQL for every registered query: the expected result written
independently of the Spark code, over the same test tables."""

from __future__ import annotations

from layerflow.functions.rules import ColumnRule
from layerflow.plans import dims
from layerflow.plans import sources_sql as S

T1, T2 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-02 00:00:00'"
RUN1_TEXT, RUN2_TEXT = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
_INT = {"int": "INTEGER", "bigint": "BIGINT"}


def typed_sql(r: ColumnRule) -> str:
    """Expected value of a rule in DuckDB, with Spark's conversion rules."""
    x = f"trim({r.source})" if r.source else None
    if r.kind == "copy":
        return r.source
    if r.kind == "text":
        return x
    if r.kind == "upper":
        return f"upper({x})"
    if r.kind == "flag":
        return f"(upper({x}) = '{(r.value or 'Y').upper()}')"
    if r.kind == "cast":
        t = r.data_type
        if t in _INT:
            return (f"(CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') "
                    f"THEN TRY_CAST({x} AS {_INT[t]}) END)")
        if t.startswith("decimal"):
            return f"TRY_CAST(NULLIF({x}, '') AS {t.upper()})"
        if t == "timestamp":
            return f"TRY_CAST(NULLIF({x}, '') AS TIMESTAMP)"
    if r.kind == "path":
        return "concat_ws(' > ', " + ", ".join(r.args) + ")"
    if r.kind == "parent_path":
        return f"concat_ws(' > ', coalesce({r.args[0]}, ''), {r.args[1]})"
    raise NotImplementedError(r)


def reject_sql(rules: list[ColumnRule]) -> str:
    parts = [f"CASE WHEN NULLIF(trim({r.source}), '') IS NOT NULL AND {typed_sql(r)} IS NULL "
             f"THEN '{r.target}' END" for r in rules if r.kind == "cast"]
    return "concat_ws(',', " + ", ".join(parts) + ")" if parts else "''"


def _landed(exprs, source, ts) -> str:
    return f"SELECT *, {ts} AS ingestion_timestamp FROM ({S.select_sql(exprs, source)})"


def _landed_text(exprs) -> str:
    return f"SELECT *, '{RUN2_TEXT}' AS ingestion_timestamp FROM ({S.select_sql(exprs, 'part')})"


_REORDERED = _landed_text(S.product_exprs("new")) + " UNION ALL " + _landed_text(S.product_exprs("new_twin"))


def product_raw_sql() -> str:
    return " UNION ALL ".join([_landed(S.product_exprs("old"), "part", T1),
                               _landed(S.product_exprs("new"), "part", T2),
                               _landed(S.product_exprs("new_twin"), "part", T2)])


def customer_raw_sql() -> str:
    return " UNION ALL ".join([_landed(S.customer_exprs("old"), S.CUSTOMER_JOIN, T1),
                               _landed(S.customer_exprs("new"), S.CUSTOMER_JOIN, T2)])


def entities_raw_sql() -> str:
    return _landed(S.ENTITIES, "supplier", T2)


def curated_cte(rules: list[ColumnRule], key: str, raw_sql: str, run_id: str = "run-2",
                run_id_sql: str | None = None) -> str:
    """``cur`` CTE: typed rows, latest per key with the full tie-break,
    plus ``_rejects`` (comma list).  ``run_id_sql`` computes the run id per
    row instead of the constant ``run_id``."""
    typed = ", ".join(f"{typed_sql(r)} AS {r.target}" for r in rules)
    order = ", ".join(["ingestion_timestamp DESC NULLS LAST"]
                      + [f"{r.target} ASC NULLS FIRST" for r in rules if r.target != key])
    return (f"typed AS (SELECT {typed}, {reject_sql(rules)} AS _rejects, ingestion_timestamp "
            f"FROM ({raw_sql})), "
            f"ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order}) AS _rn "
            f"FROM typed), "
            f"cur AS (SELECT * EXCLUDE (_rn, ingestion_timestamp), "
            f"{run_id_sql or repr(run_id)} AS job_run_id "
            f"FROM ranked WHERE _rn = 1)")


def _ts_text(cols, ts_cols=("dwh_update_date",)) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in ts_cols else c for c in cols)


def curated_sql(d: dims.Dimension, raw_sql: str) -> str:
    cols = [r.target for r in d.rules] + ["job_run_id"]
    return (f"WITH {curated_cte(d.rules, d.key, raw_sql)} "
            f"SELECT {_ts_text(cols)}, '{RUN2_TEXT}' AS curated_load_timestamp FROM cur")


def gold_sql(d: dims.Dimension, raw_sql: str, run_id_sql: str | None = None) -> str:
    loaded = f"CASE WHEN job_run_id = 'run-2' THEN '{RUN2_TEXT}' ELSE '{RUN1_TEXT}' END"
    derived = {r.target: typed_sql(r) for r in d.gold_rules}
    cols = [c for c in d.gold_order if c != "gold_load_timestamp"]
    sel = ", ".join(f"{derived[c]} AS {c}" if c in derived else
                    (f"CAST({c} AS VARCHAR) AS {c}" if c == "dwh_update_date" else c)
                    for c in cols)
    return (f"WITH {curated_cte(d.rules, d.key, raw_sql, run_id_sql=run_id_sql)} "
            f"SELECT {sel}, {loaded} AS gold_load_timestamp FROM cur")


# The incremental flow's second landing holds the customers
# whose balance is above 5000 (a change feed of part of the table).
_CHANGED = f"{S.CUSTOMER_JOIN} WHERE c_acctbal > 5000"
_INC_RUN_ID = f"CASE WHEN ingestion_timestamp = {T2} THEN 'run-2' ELSE 'run-1' END"


def _incremental_audit_sql() -> str:
    C = dims.CUSTOMER
    old, new = (_landed(S.customer_exprs("old"), S.CUSTOMER_JOIN, T1),
                _landed(S.customer_exprs("new"), _CHANGED, T2))

    def rejects(raw):
        return (f"(WITH {curated_cte(C.rules, C.key, raw)} "
                f"SELECT count(*) FILTER (WHERE _rejects <> '') FROM cur)")
    n, m = "(SELECT count(*) FROM customer)", f"(SELECT count(*) FROM {_CHANGED})"
    rows = [f"('run-1', '0', {n}, {n}, 0, 0)", f"('run-1', '1', {n}, {n}, 0, {rejects(old)})",
            f"('run-1', '2', {n}, {n}, 0, 0)", f"('run-2', '0', {m}, {m}, 0, 0)",
            f"('run-2', '1', {m}, 0, {m}, {rejects(new)})", f"('run-2', '2', {m}, 0, {m}, 0)"]
    return ("SELECT * FROM (VALUES " + ", ".join(rows) + ") AS v(job_run_id, layer, "
            "records_read, records_inserted, records_updated, records_rejected)")


_CUST_T = "(SELECT * FROM customer WHERE c_acctbal < 5000)"
_CUST_S = ("(SELECT c_custkey, c_name || '*' AS c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, "
           "c_mktsegment FROM customer WHERE c_acctbal >= 2500)")
_MERGED = (f"SELECT * FROM {_CUST_S} UNION ALL SELECT * FROM {_CUST_T} t "
           f"WHERE NOT EXISTS (SELECT 1 FROM {_CUST_S} s WHERE s.c_custkey = t.c_custkey)")


def _null_keyed(src: str, segment: str) -> str:
    return (f"(SELECT CASE WHEN c_mktsegment = '{segment}' THEN NULL ELSE c_custkey END AS c_custkey, "
            f"c_name, c_nationkey, c_acctbal, c_mktsegment FROM {src})")


_LI_LATEST = ("(SELECT * EXCLUDE (_rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, "
              "l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey ASC NULLS FIRST, "
              "l_suppkey ASC NULLS FIRST, l_quantity ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST, "
              "l_discount ASC NULLS FIRST, l_tax ASC NULLS FIRST, l_returnflag ASC NULLS FIRST, "
              "l_linestatus ASC NULLS FIRST) AS _rn FROM lineitem) WHERE _rn = 1)")
_LI_T = f"(SELECT * FROM {_LI_LATEST} WHERE l_returnflag <> 'N' OR l_linestatus = 'F')"
_LI_S = (f"(SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM {_LI_LATEST} "
         f"WHERE l_linestatus = 'O')")

_META = ("(SELECT 'DIM_PART_' || CAST(p_partkey AS VARCHAR) AS table_id, 'FILE' AS source_system, "
         "'/drop/' || p_name || '.csv' AS source_table, "
         "CASE WHEN p_size > 25 THEN 'FACT' ELSE 'DIMENSION' END AS table_group, "
         "CASE WHEN p_size <= 10 THEN NULL ELSE p_size % 3 <> 0 END AS table_is_active, "
         "'MERGE' AS layer1_load_type, p_brand AS layer1_target_table, "
         "CAST(NULL AS VARCHAR) AS layer0_target_table FROM part)")

_ORDERS = ("SELECT o_orderkey, o_custkey, {status} AS o_orderstatus, o_totalprice, "
           "CAST(o_orderdate AS VARCHAR) AS o_orderdate, {prio} AS o_orderpriority FROM orders")

# Events by day, purchases without a time; the latest per user by time, then id.
_EVENT_DAYS = ("(SELECT * REPLACE (CASE WHEN event_type <> 'purchase' THEN date_trunc('day', ts)::TIMESTAMP END AS ts) "
               "FROM events)")
_LATEST_EVENT = (f"(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, "
                 f"event_id DESC NULLS LAST) AS _rn FROM {_EVENT_DAYS}) WHERE _rn = 1)")
_LATEST_EVENT_ROWS = (f"SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props "
                      f"FROM {_LATEST_EVENT}")
_LATE = ("FROM orders, (SELECT max(o_orderdate) - INTERVAL 60 DAY AS bound FROM orders "
         "WHERE o_orderpriority <> '1-URGENT' AND o_orderdate <= DATE '1997-06-30') WHERE o_orderpriority ")

_MALFORMED = ("SELECT p_partkey || ',' || p_brand || CASE WHEN p_size > 45 THEN ',' || p_size || ',extra' ELSE '' END "
              "AS raw_line, true AS from_csv_file, 'run-2' AS job_run_id, '2024-01-02 00:00:00' AS "
              "rejected_load_timestamp FROM part WHERE p_size <= 5 OR p_size > 45")

_RANGE_FROM = "FROM orders, (SELECT max(o_orderkey) AS top FROM orders)"
_RANGE_MERGED = ("SELECT o_orderkey, o_custkey, {status} AS o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS "
                 "o_orderdate, CASE WHEN o_orderkey > 0.8 * top THEN '0-NOW' ELSE o_orderpriority END AS o_orderpriority")

_P_RULES = dims.PRODUCT_RULES
_MAP_RULES = [ColumnRule("product_id", "PRODUCT_ID"), ColumnRule("description", "DESCRIPTION"),
              ColumnRule("brand", "BRAND"), ColumnRule("pack", "PACK"),
              ColumnRule("gas_exchange", "GAS_EXCHANGE")]
_RULES_RULES = [ColumnRule("product_id", "PRODUCT_ID"), ColumnRule("description", "DESCRIPTION"),
                ColumnRule("brand", "BRAND"),
                ColumnRule("pack", "PACK", "cast", "decimal(18,5)"),
                ColumnRule("gas_exchange", "GAS_EXCHANGE", "flag"),
                ColumnRule("brand_upper", "BRAND", "upper"),
                ColumnRule("qty", "CYLINDER_QTY", "cast", "int")]


# `orders` statuses with NULL and empty ones, as a partitioned table stores them.
_BLANK = ("CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL ELSE nullif(o_orderstatus, '') END")
_PER_ORDER = ("per_order AS (SELECT l_orderkey, max(l_linenumber) AS l_linenumber, max(l_partkey) AS l_partkey, "
              "max(l_suppkey) AS l_suppkey, max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice, "
              "max(l_discount) AS l_discount, max(l_tax) AS l_tax, max(l_returnflag) AS l_returnflag, "
              "max(l_linestatus) AS l_linestatus, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY l_orderkey), "
              "big AS (SELECT * FROM per_order WHERE l_quantity >= 40), "
              "small AS (SELECT * FROM per_order WHERE l_quantity < 10)")


def _rejects_table_sql() -> str:
    """Raw text of the landed product rows whose PACK or CYLINDER_QTY does not convert."""
    rows = (f"SELECT * FROM ({S.select_sql(S.product_exprs('new'), 'part')}) UNION "
            f"SELECT * FROM ({S.select_sql(S.product_exprs('new_twin'), 'part')})")
    return (f"SELECT *, '{RUN2_TEXT}' AS rejected_load_timestamp, 'run-2' AS job_run_id FROM (SELECT *, concat_ws(',', "
            f"CASE WHEN trim(PACK) = 'n/a' THEN 'pack' END, CASE WHEN trim(CYLINDER_QTY) IN ('x', '1.5') "
            f"THEN 'cylinder_qty' END) AS rejected_columns FROM ({rows})) WHERE rejected_columns <> ''")


def _gold_by_metadata_sql() -> str:
    cols = [r.target for r in _RULES_RULES] + ["job_run_id"]
    return (f"WITH {curated_cte(_RULES_RULES, 'product_id', product_raw_sql())} SELECT {', '.join(cols)}, "
            f"concat_ws(' > ', brand, description) AS label, '{RUN2_TEXT}' AS gold_load_timestamp FROM cur")


def _run_active_failure_sql() -> str:
    rows = []
    for tid, src, n0 in (("DIM_PRODUCT", "part", "2 * count(*)"), ("DIM_ENTITIES", "supplier", "count(*)")):
        rows += [f"SELECT '{tid}' AS table_name, '0' AS layer, 'SUCCESS' AS status, {n0} AS records_read, "
                 f"NULL::VARCHAR AS error_message FROM {src}"]
        rows += [f"SELECT '{tid}', '{k}', 'SUCCESS', count(*), NULL FROM {src}" for k in (1, 2)]
    error = "'no transform registered as ' || chr(39) || 'missing.l1' || chr(39)"
    rows += ["SELECT 'DIM_CUSTOMER', '0', 'SUCCESS', count(*), NULL FROM customer",
             f"SELECT 'DIM_CUSTOMER', '1', 'REJECTED', 0, {error}"]
    return f"SELECT *, 'DIM_CUSTOMER' AS failed FROM ({' UNION ALL '.join(rows)})"


def _rules_sql(rules) -> str:
    cols = [r.target for r in rules] + ["job_run_id"]
    return (f"WITH {curated_cte(rules, 'product_id', product_raw_sql())} "
            f"SELECT {', '.join(cols)}, '{RUN2_TEXT}' AS curated_load_timestamp FROM cur")


def _product_gold_counts() -> str:
    """Audit rows expected from one product pipeline run (``runs`` = times)."""
    n = "(SELECT count(*) FROM part)"
    # the two landed versions of a row differ as text, so both are rejected
    rej = "(SELECT 2 * count(*) FROM part WHERE p_size IN (1, 3, 7))"
    return n, rej


def oracle_sql() -> dict[str, str]:
    P, C, E = dims.PRODUCT, dims.CUSTOMER, dims.ENTITIES
    n, rej = _product_gold_counts()
    out = {
        "land_csv": _landed_text(S.product_exprs("new")),
        "land_csv_reordered": _REORDERED,
        "land_lineage": ("SELECT CAST(o_orderkey AS VARCHAR) AS O_ORDERKEY, "
                         "NULLIF(o_orderstatus, '') AS O_ORDERSTATUS, true AS from_csv_file, "
                         "'2024-01-02 00:00:00' AS ingestion_timestamp, 'run-2' AS job_run_id "
                         "FROM orders"),
        "table_scan": "SELECT * FROM part",
        "stream_land": _landed_text(S.product_exprs("new")),
        "curate_product": curated_sql(P, product_raw_sql()),
        "curate_customer": curated_sql(C, customer_raw_sql()),
        "curate_entities": curated_sql(E, entities_raw_sql()),
        "quarantine_rejects": _rejects_table_sql(),
        "dedup_latest": ("SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props "
                         "FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC "
                         "NULLS LAST, event_id DESC NULLS LAST, event_type ASC NULLS FIRST, "
                         "value ASC NULLS FIRST, props ASC NULLS FIRST) AS _rn FROM events) "
                         "WHERE _rn = 1"),
        "dedup_composite": (f"SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) "
                            f"FROM {_LI_LATEST}"),
        "gold_product_path": gold_sql(P, product_raw_sql()),
        "gold_customer_path": gold_sql(C, customer_raw_sql()),
        "gold_entities": gold_sql(E, entities_raw_sql()),
        "publish_append": _ORDERS.format(status="o_orderstatus", prio="o_orderpriority"),
        "merge_first_run": "SELECT * FROM supplier",
        "merge_upsert": _MERGED,
        "merge_upsert_broadcast": _MERGED,
        "merge_bucketed": _MERGED,
        "merge_metrics": (f"SELECT (SELECT count(*) FROM {_CUST_S}) AS records_read, "
                          f"count(*) FILTER (WHERE t.c_custkey IS NULL) AS records_inserted, "
                          f"count(*) FILTER (WHERE t.c_custkey IS NOT NULL) AS records_updated "
                          f"FROM {_CUST_S} s LEFT JOIN {_CUST_T} t ON s.c_custkey = t.c_custkey"),
        "merge_composite_key": (
            f"SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM ("
            f"SELECT * FROM {_LI_S} UNION ALL SELECT * FROM {_LI_T} t WHERE NOT EXISTS "
            f"(SELECT 1 FROM {_LI_S} s WHERE s.l_orderkey = t.l_orderkey "
            f"AND s.l_linenumber = t.l_linenumber))"),
        "merge_null_key": (
            f"SELECT * FROM {_null_keyed(_CUST_S, 'BUILDING')} UNION ALL "
            f"SELECT * FROM {_null_keyed(_CUST_T, 'AUTOMOBILE')} t WHERE t.c_custkey IS NULL OR NOT EXISTS "
            f"(SELECT 1 FROM {_null_keyed(_CUST_S, 'BUILDING')} s WHERE s.c_custkey = t.c_custkey)"),
        "merge_cardinality": (
            "SELECT c_custkey, c_name, true AS error_raised, (SELECT count(*) FROM (SELECT o_custkey FROM orders "
            "WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY o_custkey HAVING count(*) > 1)) "
            "AS ambiguous_keys FROM customer"),
        "merge_unmatched_repeats": (
            "SELECT c_custkey, c_name || '*' AS c_name FROM customer UNION ALL "
            "SELECT -o_custkey - 1, o_orderpriority FROM orders"),
        "merge_repeated_target": (
            f"SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM (WITH {_PER_ORDER} "
            f"SELECT b.* FROM lineitem l JOIN big b USING (l_orderkey) UNION ALL BY NAME "
            f"SELECT l.* FROM lineitem l WHERE l_orderkey NOT IN (SELECT l_orderkey FROM big) UNION ALL BY NAME "
            f"SELECT * REPLACE (-l_orderkey AS l_orderkey) FROM small)"),
        "merge_repeated_target_metrics": (
            f"WITH {_PER_ORDER} SELECT (SELECT count(*) FROM big) + (SELECT count(*) FROM small) AS records_read, "
            f"(SELECT count(*) FROM small) AS records_inserted, "
            f"(SELECT count(*) FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM big)) AS records_updated"),
        "merge_partition_null": (
            f"SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority <> '3-MEDIUM' THEN {_BLANK} END "
            f"AS o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders "
            f"UNION ALL SELECT -o_orderkey - 1, o_custkey, NULL, o_totalprice, CAST(o_orderdate AS VARCHAR), "
            f"o_orderpriority FROM orders WHERE o_orderpriority = '5-LOW'"),
        "update_partition_blank": (
            f"SELECT * REPLACE (CASE WHEN o_orderstatus IS NULL THEN 'none' ELSE o_orderpriority END AS o_orderpriority) "
            f"FROM (" + _ORDERS.format(status=f"nullif({_BLANK}, 'P')", prio="o_orderpriority") + ")"),
        "drop_recreate": "SELECT * REPLACE (lower(c_name) AS c_name), true AS was_gone FROM customer",
        "gold_by_metadata": _gold_by_metadata_sql(),
        "audit_fields": (
            "SELECT 'run-2' AS job_run_id, 'PRODUCT' AS table_name, layer, 'RU-7' AS reporting_unit_id, "
            "'SUCCESS' AS status, n AS records_read, n AS records_inserted, 0::BIGINT AS records_updated, "
            "CASE WHEN layer = '1' THEN r ELSE 0 END AS records_rejected, true AS by_session_user, "
            "true AS ends_after_start, NULL::VARCHAR AS error_message FROM (VALUES ('1'), ('2')) v(layer), "
            "(SELECT count(*) AS n, 2 * count(*) FILTER (p_size IN (1, 3, 7)) AS r FROM part)"),
        "audit_compact": ("SELECT 'DIM_ENTITIES' AS table_name, layer, 'SUCCESS' AS status, count(*) AS records_read, "
                          "true AS fewer_files FROM supplier, (VALUES ('0'), ('1'), ('2')) v(layer) GROUP BY layer"),
        "incremental_null_watermark": (
            "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props FROM (SELECT *, ROW_NUMBER() "
            "OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS _rn FROM (SELECT * REPLACE "
            "(CASE WHEN event_type <> 'purchase' THEN ts END AS ts) FROM events)) WHERE _rn = 1"),
        "incremental_ties": _ORDERS.format(status="o_orderstatus", prio="o_orderpriority"),
        "incremental_numeric_text": ("SELECT *, CAST(o_orderkey AS VARCHAR) AS seq FROM ("
                                     + _ORDERS.format(status="o_orderstatus", prio="o_orderpriority") + ")"),
        "incremental_late": (
            f"SELECT orders.* REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate), "
            f"(SELECT count(*) {_LATE} = '1-URGENT' AND o_orderdate < bound) AS too_late "
            f"{_LATE} <> '1-URGENT' OR o_orderdate >= bound"),
        "stream_land_reordered": _REORDERED,
        "land_rerun": _REORDERED + " UNION ALL " + _landed_text(S.product_exprs("old")),
        "land_rerun_audit": (
            "SELECT '0' AS layer, k * n AS records_read, k * n AS records_inserted, 0::BIGINT AS records_updated, "
            "0::BIGINT AS records_rejected FROM (SELECT count(*) AS n FROM part), (VALUES (2), (0), (1)) AS v(k)"),
        "quarantine_malformed": _MALFORMED,
        "stream_quarantine_malformed": _MALFORMED,
        "quarantine_malformed_audit": (
            "SELECT n AS records_read, n - bad AS records_inserted, bad AS records_rejected, 2 * (n - bad) AS landed, "
            "2 * (n - bad) AS with_size FROM (SELECT count(*) AS n, count(*) FILTER (WHERE p_size <= 5 OR p_size > 45) "
            "AS bad FROM part), (VALUES (1), (2)) AS v(run)"),
        "merge_range_pruned": (_RANGE_MERGED.format(status="o_orderstatus") + ", true AS most_ranges_kept " + _RANGE_FROM),
        "update_range_pruned": (_RANGE_MERGED.format(
            status="CASE WHEN o_orderkey < (SELECT min(o_orderkey) + 100 FROM orders) THEN 'X' ELSE o_orderstatus END")
            + ", 1::BIGINT AS ranges_rewritten " + _RANGE_FROM),
        "merge_range_metrics": (
            "SELECT count(*) FILTER (WHERE o_orderkey > 0.8 * top) AS records_read, count(*) FILTER (WHERE o_orderkey > "
            "0.9 * top) AS records_inserted, count(*) FILTER (WHERE o_orderkey > 0.8 * top AND o_orderkey <= 0.9 * top) "
            "AS records_updated " + _RANGE_FROM),
        "merge_if_newer": _LATEST_EVENT_ROWS,
        "run_if_newer": _LATEST_EVENT_ROWS,
        "merge_if_newer_metrics": (
            f"SELECT (SELECT count(*) FROM events WHERE event_type = 'view') AS records_read, "
            f"count(*) FILTER (WHERE event_type = 'view' AND NOT known) AS records_inserted, "
            f"count(*) FILTER (WHERE event_type = 'view' AND known) AS records_updated FROM (SELECT *, user_id IN "
            f"(SELECT user_id FROM events WHERE event_type <> 'view') AS known FROM {_LATEST_EVENT})"),
        "run_active_failure": _run_active_failure_sql(),
        "merge_schema_fit": _MERGED,
        "not_null_check": "SELECT *, 'MERGE,APPEND' AS raised FROM customer WHERE c_custkey IS NOT NULL",
        "insert_values": f"SELECT * FROM {_META}",
        "metadata_lookup": (f"SELECT table_id, source_table, table_group, table_is_active "
                            f"FROM {_META} WHERE table_id = 'DIM_PART_7'"),
        "active_tables": f"SELECT table_id FROM {_META} WHERE table_is_active ORDER BY table_id",
        "active_tables_group": (f"SELECT table_id FROM {_META} WHERE table_is_active "
                                f"AND table_group = 'DIMENSION' ORDER BY table_id"),
        "update_where": _ORDERS.format(
            status="o_orderstatus",
            prio="CASE WHEN o_orderstatus = 'P' THEN '0-URGENT' ELSE o_orderpriority END"),
        "update_all": _ORDERS.format(status="o_orderstatus", prio="'10'"),
        "update_in_list": _ORDERS.format(
            status="CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'X' ELSE o_orderstatus END",
            prio="o_orderpriority"),
        "add_column_backfill": ("SELECT *, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'FACT' "
                                "ELSE 'DIMENSION' END AS table_group FROM customer"),
        "create_schema": "SELECT *, 'it''s ours' AS comment, true AS in_place, 1::BIGINT AS tables FROM region",
        "create_target": curated_sql(P, product_raw_sql()),
        "column_mapping": _rules_sql(_MAP_RULES),
        "transformation_rules": _rules_sql(_RULES_RULES),
        "custom_transform": ("SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_totalprice "
                             ">= 200000 THEN 'HIGH' ELSE 'LOW' END AS value_band FROM orders "
                             "WHERE o_orderstatus = 'O'"),
        "incremental_read": ("SELECT * REPLACE (CAST(ts AS VARCHAR) AS ts) FROM events WHERE ts > "
                             "(SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15')"),
        "append_compacts": ("SELECT *, 2 AS packed, true AS fewer, true AS others_kept FROM ("
                            + _ORDERS.format(status="o_orderstatus", prio="o_orderpriority") + ")"),
        "partitioned_write": _ORDERS.format(status="o_orderstatus", prio="o_orderpriority")
                             + " WHERE o_orderstatus = 'O'",
        "merge_partitioned": _ORDERS.format(
            status="o_orderstatus",
            prio="CASE WHEN o_orderstatus = 'P' THEN '0-NOW' ELSE o_orderpriority END"),
        "merge_partition_moves": (
            "SELECT c_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 5000 "
            "THEN 'changed' ELSE c_name END AS c_name, c_nationkey, c_acctbal, "
            "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'X/new' ELSE c_mktsegment END AS c_mktsegment "
            "FROM customer"),
        "update_partitioned": _ORDERS.format(
            status="o_orderstatus",
            prio="CASE WHEN o_orderstatus = 'P' THEN '0-URGENT' ELSE o_orderpriority END"),
        "run_table": gold_sql(P, " UNION ALL ".join([
            _landed(S.product_exprs("new"), "part", T2),
            _landed(S.product_exprs("new_twin"), "part", T2)])),
        "run_table_bucketed": gold_sql(P, " UNION ALL ".join([
            _landed(S.product_exprs("new"), "part", T2),
            _landed(S.product_exprs("new_twin"), "part", T2)])),
        "run_incremental": gold_sql(C, " UNION ALL ".join([
            _landed(S.customer_exprs("old"), S.CUSTOMER_JOIN, T1),
            _landed(S.customer_exprs("new"), _CHANGED, T2)]), run_id_sql=_INC_RUN_ID),
        "run_incremental_audit": _incremental_audit_sql(),
        "run_stream_landing": gold_sql(C, " UNION ALL ".join([
            _landed(S.customer_exprs("old"), S.CUSTOMER_JOIN, T1),
            _landed(S.customer_exprs("new"), _CHANGED, T2)]), run_id_sql=_INC_RUN_ID),
        "run_stream_landing_audit": _incremental_audit_sql(),
        "run_layer": curated_sql(C, _landed(S.customer_exprs("new"), S.CUSTOMER_JOIN, T2)),
        "run_layer_skip": ("SELECT 'DIM_ENTITIES' AS table_name, '0' AS layer, 'SUCCESS' AS status, "
                           "count(*) AS records_read, count(*) AS records_inserted, "
                           "0::BIGINT AS records_updated, 0::BIGINT AS records_rejected FROM supplier "
                           "UNION ALL SELECT 'DIM_ENTITIES', '1', 'SKIPPED', 0, 0, 0, 0"),
        "run_active": _run_active_sql(),
        "audit_buffered": f"SELECT *, true AS few_files FROM ({_run_active_sql()})",
        "audit_lifecycle": (
            f"SELECT * FROM (VALUES "
            f"('DIM_PRODUCT', '0', 'SUCCESS', 2 * {n}, 2 * {n}, 0, {0}, 2), "
            f"('DIM_PRODUCT', '1', 'SUCCESS', {n}, {n}, 0, {rej}, 1), "
            f"('DIM_PRODUCT', '1', 'SUCCESS', {n}, 0, {n}, {rej}, 1), "
            f"('DIM_PRODUCT', '2', 'SUCCESS', {n}, {n}, 0, 0, 1), "
            f"('DIM_PRODUCT', '2', 'SUCCESS', {n}, 0, {n}, 0, 1)) "
            f"AS v(table_name, layer, status, records_read, records_inserted, records_updated, "
            f"records_rejected, runs)"),
    }
    return out


def _run_active_sql() -> str:
    rows = []
    for tid, src, n0, rej in (
            ("DIM_PRODUCT", "part", "2 * (SELECT count(*) FROM part)",
             "(SELECT 2 * count(*) FROM part WHERE p_size IN (1, 3, 7))"),
            ("DIM_CUSTOMER", "customer", "(SELECT count(*) FROM customer)",
             "(SELECT count(*) FROM customer WHERE c_acctbal < 100)"),
            ("DIM_ENTITIES", "supplier", "(SELECT count(*) FROM supplier)",
             "(SELECT count(*) FROM supplier WHERE s_acctbal < 0)")):
        n = f"(SELECT count(*) FROM {src})"
        rows += [f"('{tid}', '0', 'SUCCESS', {n0}, {n0}, 0, 0)",
                 f"('{tid}', '1', 'SUCCESS', {n}, {n}, 0, {rej})",
                 f"('{tid}', '2', 'SUCCESS', {n}, {n}, 0, 0)"]
    return ("SELECT * FROM (VALUES " + ", ".join(rows) + ") AS v(table_name, layer, status, "
            "records_read, records_inserted, records_updated, records_rejected)")
