"""The three dimensions (product, customer, entities) as declared rules.

Column names and types below are fixed values: they must equal the tables
the dimensions are read from and published to.
"""

from __future__ import annotations

from pyspark.sql import types as T

from layerflow.functions.rules import ColumnRule

R = ColumnRule

# Landing file columns (header names), in file order.
PRODUCT_RAW = ["PRODUCT_ID", "DESCRIPTION", "PRODUCT_GROUP", "SUB_GROUP", "SUB_SUB_GROUP",
               "SUB_SUB_SUB_GROUP", "COLORFLAVOR", "FLAVOR_FAMILY", "PACK", "CONFIGURATION",
               "BRAND", "EDITION", "SCREW", "CYLINDER_QTY", "GAS_EXCHANGE"]
CUSTOMER_RAW = ["INDEXS", "CUSTOMER_ID", "CUSTOMER_NAME", "CUSTOMER_GROUP", "CUSTOMER_GROUP2",
                "CUSTOMER_GROUP3", "CUSTOMERPARENTID", "PARENTNAME", "PATHNAME", "DEPTH",
                "BT_CITY", "BT_PROVINCE", "PROVINCE", "COUNTRY"]
ENTITIES_RAW = ["ENTITY_CODE", "ENTITY_NAME", "ENTITY_GROUP", "ENTITY_GROUP_SHORT_NAME",
                "DEFAULT_MARKET", "COMPANY", "DWH_UPDATE_DATE"]

# Curation rules (target, source, kind, type).
PRODUCT_RULES = [
    R("product_id", "PRODUCT_ID"), R("description", "DESCRIPTION"),
    R("product_group", "PRODUCT_GROUP"), R("sub_group", "SUB_GROUP"),
    R("sub_sub_group", "SUB_SUB_GROUP"), R("sub_sub_sub_group", "SUB_SUB_SUB_GROUP"),
    R("color_flavor", "COLORFLAVOR"), R("flavor_family", "FLAVOR_FAMILY"),
    R("pack", "PACK", "cast", "decimal(18,5)"), R("configuration", "CONFIGURATION"),
    R("brand", "BRAND"), R("edition", "EDITION"), R("screw", "SCREW"),
    R("cylinder_qty", "CYLINDER_QTY", "cast", "int"), R("gas_exchange", "GAS_EXCHANGE", "flag"),
]
CUSTOMER_RULES = [
    R("customer_id", "CUSTOMER_ID"), R("customer_name", "CUSTOMER_NAME"),
    R("customer_group", "CUSTOMER_GROUP"), R("customer_group2", "CUSTOMER_GROUP2"),
    R("customer_group3", "CUSTOMER_GROUP3"), R("customer_parent_id", "CUSTOMERPARENTID"),
    R("parent_name", "PARENTNAME"), R("path_name", "PATHNAME"),
    R("depth", "DEPTH", "cast", "bigint"), R("bt_city", "BT_CITY"),
    R("bt_province", "BT_PROVINCE"), R("province", "PROVINCE"), R("country", "COUNTRY"),
]
ENTITIES_RULES = [
    R("entity_code", "ENTITY_CODE"), R("entity_name", "ENTITY_NAME"),
    R("entity_group", "ENTITY_GROUP"), R("entity_group_short_name", "ENTITY_GROUP_SHORT_NAME"),
    R("default_market", "DEFAULT_MARKET"), R("company", "COMPANY"),
    R("dwh_update_date", "DWH_UPDATE_DATE", "cast", "timestamp"),
]

# Gold derived columns.
PRODUCT_GOLD_RULES = [R("product_category_path", kind="path",
                        args=("product_group", "sub_group", "sub_sub_group", "sub_sub_sub_group"))]
CUSTOMER_GOLD_RULES = [R("customer_hierarchy_path", kind="parent_path",
                         args=("parent_name", "customer_name"))]

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
          "decimal(18,5)": T.DecimalType(18, 5), "boolean": T.BooleanType(),
          "timestamp": T.TimestampType()}


def _schema(cols: list[tuple[str, str]], key: str | None) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], n != key) for n, t in cols])


def _rule_type(r: ColumnRule) -> str:
    return r.data_type if r.kind == "cast" else ("boolean" if r.kind == "flag" else "string")


def raw_schema(columns: list[str]) -> T.StructType:
    return _schema([(c, "string") for c in columns]
                   + [("source_file_name", "string"), ("ingestion_timestamp", "timestamp"),
                      ("job_run_id", "string")], None)


def curated_schema(rules: list[ColumnRule], key: str) -> T.StructType:
    return _schema([(r.target, _rule_type(r)) for r in rules]
                   + [("curated_load_timestamp", "timestamp"), ("job_run_id", "string")], key)


# Gold column order per dimension.
PRODUCT_GOLD_ORDER = ["product_id", "description", "product_group", "sub_group", "sub_sub_group",
                      "sub_sub_sub_group", "product_category_path", "color_flavor",
                      "flavor_family", "pack", "configuration", "brand", "edition", "screw",
                      "cylinder_qty", "gas_exchange", "gold_load_timestamp", "job_run_id"]
CUSTOMER_GOLD_ORDER = ["customer_id", "customer_name", "customer_group", "customer_group2",
                       "customer_group3", "customer_parent_id", "parent_name",
                       "customer_hierarchy_path", "depth", "bt_city", "bt_province", "province",
                       "country", "gold_load_timestamp", "job_run_id"]
ENTITIES_GOLD_ORDER = ["entity_code", "entity_name", "entity_group", "entity_group_short_name",
                       "default_market", "company", "dwh_update_date", "gold_load_timestamp",
                       "job_run_id"]


def gold_schema(curated: T.StructType, extra: list[ColumnRule], order: list[str],
                key: str) -> T.StructType:
    types = {f.name: f.dataType for f in curated.fields}
    types.update({r.target: T.StringType() for r in extra})
    types["gold_load_timestamp"] = T.TimestampType()
    return T.StructType([T.StructField(c, types[c], c != key) for c in order])


class Dimension:
    def __init__(self, name, raw, rules, key, gold_rules, gold_order):
        self.name, self.raw, self.rules, self.key = name, raw, rules, key
        self.gold_rules, self.gold_order = gold_rules, gold_order
        self.raw_schema = raw_schema(raw)
        self.curated_schema = curated_schema(rules, key)
        self.gold_schema = gold_schema(self.curated_schema, gold_rules, gold_order, key)


PRODUCT = Dimension("dim_product", PRODUCT_RAW, PRODUCT_RULES, "product_id",
                    PRODUCT_GOLD_RULES, PRODUCT_GOLD_ORDER)
CUSTOMER = Dimension("dim_customer", CUSTOMER_RAW, CUSTOMER_RULES, "customer_id",
                     CUSTOMER_GOLD_RULES, CUSTOMER_GOLD_ORDER)
ENTITIES = Dimension("dim_entities", ENTITIES_RAW, ENTITIES_RULES, "entity_code",
                     [], ENTITIES_GOLD_ORDER)
DIMENSIONS = {d.name: d for d in (PRODUCT, CUSTOMER, ENTITIES)}
