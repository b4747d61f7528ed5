"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from layerflow.functions.cleaning import (
    blank_to_null,
    clean_text,
    flag,
    hierarchy_path,
    parent_path,
    typed,
)
from layerflow.functions.rules import (
    ColumnRule,
    apply_rules,
    parse_column_mapping,
    parse_transformation_rules,
    rules_from_mapping,
)

__all__ = [
    "ColumnRule", "apply_rules", "blank_to_null", "clean_text", "flag",
    "hierarchy_path", "parent_path", "parse_column_mapping",
    "parse_transformation_rules", "rules_from_mapping", "typed",
]
