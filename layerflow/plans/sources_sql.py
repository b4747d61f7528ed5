"""How the driver test tables stand in for the three dimension sources.

Each landing column is one SQL expression over a test table, written so that
Spark (``selectExpr``) and DuckDB read it the same way; the rows are made
dirty on purpose (padding, blanks, bad numbers, mixed-case flags, NULL
levels) so the curation rules have work to do.  These expressions only
*build inputs*; the library code under test never sees them.
"""

from __future__ import annotations

# Product landing columns derived from `part`.
_PRODUCT = [
    ("PRODUCT_ID", "concat(' ', CAST(p_partkey AS STRING), ' ')"),
    ("DESCRIPTION", "{desc}"),
    ("PRODUCT_GROUP", "CASE WHEN p_size <= 5 THEN NULL ELSE p_type END"),
    ("SUB_GROUP", "concat(p_brand, '  ')"),
    ("SUB_SUB_GROUP", "CASE WHEN p_size >= 45 THEN NULL ELSE concat(' ', p_name) END"),
    ("SUB_SUB_SUB_GROUP", "CASE WHEN p_size BETWEEN 20 AND 30 THEN p_brand ELSE NULL END"),
    ("COLORFLAVOR", "upper(p_name)"),
    ("FLAVOR_FAMILY", "lower(p_type)"),
    ("PACK", "CASE WHEN p_size = 7 THEN 'n/a' ELSE concat(' ', CAST(p_retailprice AS STRING)) END"),
    ("CONFIGURATION", "CASE WHEN p_size > 40 THEN '' ELSE p_type END"),
    ("BRAND", "p_brand"),
    ("EDITION", "concat('E', CAST(p_size AS STRING))"),
    ("SCREW", "{screw}"),
    ("CYLINDER_QTY", "CASE WHEN p_size = 1 THEN 'x' WHEN p_size = 2 THEN ' ' WHEN p_size = 3 "
                     "THEN '1.5' ELSE concat(' ', CAST(p_size AS STRING), ' ') END"),
    ("GAS_EXCHANGE", "CASE WHEN p_size < 10 THEN 'y' WHEN p_size < 20 THEN ' Y ' "
                     "WHEN p_size < 30 THEN 'N' WHEN p_size < 40 THEN '' ELSE NULL END"),
]
_SCREW_A = "CASE WHEN p_size < 10 THEN ' ' ELSE 'S' END"
_SCREW_B = "CASE WHEN p_size < 10 THEN NULL ELSE 'T' END"


def product_exprs(version: str = "new") -> list[tuple[str, str]]:
    """``old``: first landing (older descriptions); ``new``: current rows;
    ``new_twin``: a same-timestamp copy differing in SCREW only."""
    desc = "concat('old ', p_name)" if version == "old" else "p_name"
    screw = _SCREW_B if version == "new_twin" else _SCREW_A
    return [(c, e.format(desc=desc, screw=screw)) for c, e in _PRODUCT]


# Customer landing columns from `customer` LEFT JOIN `nation`
# (nations of region 4 give no parent).
CUSTOMER_JOIN = ("customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 4) n "
                 "ON c_nationkey = n.n_nationkey")
_CUSTOMER = [
    ("INDEXS", "CAST(c_custkey AS STRING)"),
    ("CUSTOMER_ID", "concat(CAST(c_custkey AS STRING), ' ')"),
    ("CUSTOMER_NAME", "{name}"),
    ("CUSTOMER_GROUP", "c_mktsegment"),
    ("CUSTOMER_GROUP2", "lower(c_mktsegment)"),
    ("CUSTOMER_GROUP3", "CASE WHEN c_acctbal < 0 THEN NULL ELSE 'G3' END"),
    ("CUSTOMERPARENTID", "CAST(n_nationkey AS STRING)"),
    ("PARENTNAME", "n_name"),
    ("PATHNAME", "concat(coalesce(n_name, '?'), '/', c_name)"),
    ("DEPTH", "CASE WHEN c_acctbal < 100 THEN 'deep' ELSE concat(' ', CAST(c_nationkey AS STRING)) END"),
    ("BT_CITY", "concat('City ', CAST(c_nationkey AS STRING))"),
    ("BT_PROVINCE", "CASE WHEN c_nationkey < 5 THEN ' ' ELSE 'Prov' END"),
    ("PROVINCE", "'P'"),
    ("COUNTRY", "n_name"),
]


def customer_exprs(version: str = "new") -> list[tuple[str, str]]:
    name = "concat(' ', c_name, ' (old)')" if version == "old" else "concat(' ', c_name)"
    return [(c, e.format(name=name)) for c, e in _CUSTOMER]


# Entities landing columns derived from `supplier`.
ENTITIES = [
    ("ENTITY_CODE", "CAST(s_suppkey AS STRING)"),
    ("ENTITY_NAME", "concat(s_name, ' ')"),
    ("ENTITY_GROUP", "concat('G', CAST(s_nationkey AS STRING))"),
    ("ENTITY_GROUP_SHORT_NAME", "CASE WHEN s_nationkey > 20 THEN NULL ELSE 'g' END"),
    ("DEFAULT_MARKET", "'MKT'"),
    ("COMPANY", "CASE WHEN s_acctbal < 0 THEN '' ELSE 'ACME' END"),
    ("DWH_UPDATE_DATE", "CASE WHEN s_acctbal < 0 THEN '01/02/2024' ELSE concat('2024-03-', "
                        "lpad(CAST(s_nationkey + 1 AS STRING), 2, '0'), ' 10:00:00') END"),
]


def select_sql(exprs: list[tuple[str, str]], source: str, landed: bool = True) -> str:
    """SELECT list as DuckDB sees a landed CSV: '' arrives as NULL."""
    cols = [f"NULLIF({e}, '') AS {c}" if landed else f"{e} AS {c}" for c, e in exprs]
    return "SELECT " + ", ".join(cols) + " FROM " + source
