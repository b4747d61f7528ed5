"""Declarative column rules: rename, trim, typed cast, flag, path, default.

A table is described by an ordered list of :class:`ColumnRule`; applying the
list is one ``select``, so Catalyst sees a single projection that stays in
whole-stage codegen.  Rules can also come from metadata: a JSON object for
the column mapping and a JSON list for the transformation rules.  Only the
rule kinds below are accepted; nothing in the metadata is evaluated as code.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.functions import cleaning as C

REJECT_COLUMN = "_rejected_columns"


def has_rejects(column: str = REJECT_COLUMN):
    return F.col(column) != F.lit("")

RULE_KINDS = ("copy", "text", "upper", "lower", "blank_to_null", "cast", "flag",
              "path", "parent_path", "default")


@dataclass(frozen=True)
class ColumnRule:
    target: str
    source: str | None = None
    kind: str = "text"
    data_type: str | None = None
    args: tuple = field(default_factory=tuple)
    value: object = None

    def __post_init__(self):
        if self.kind not in RULE_KINDS:
            raise ValueError(f"unknown rule kind {self.kind!r} for {self.target}")
        if self.kind == "cast" and not self.data_type:
            raise ValueError(f"cast rule for {self.target} needs data_type")
        if self.kind in ("path", "parent_path") and not self.args:
            raise ValueError(f"{self.kind} rule for {self.target} needs columns")

    def expression(self) -> Column:
        src = F.col(self.source) if self.source else None
        k = self.kind
        if k == "copy":
            return src
        if k == "text":
            return C.clean_text(src)
        if k == "upper":
            return F.upper(C.clean_text(src))
        if k == "lower":
            return F.lower(C.clean_text(src))
        if k == "blank_to_null":
            return C.blank_to_null(src)
        if k == "cast":
            return C.typed(src, self.data_type)
        if k == "flag":
            return C.flag(src, self.value or "Y")
        if k == "path":
            return C.hierarchy_path(*self.args)
        if k == "parent_path":
            return C.parent_path(self.args[0], self.args[1])
        if k == "default":
            return F.coalesce(src, F.lit(self.value))
        raise AssertionError(k)

    def failure(self) -> Column | None:
        """Reject condition for typed rules: text present, value NULL."""
        if self.kind != "cast":
            return None
        return C.cast_failed(F.col(self.source), self.expression())


def failed_targets(rules: list[ColumnRule]) -> Column:
    """Comma-separated targets whose cast failed on a row ('' when it is clean).  ``concat_ws`` skips
    NULLs and stays in whole-stage codegen (a lambda based array filter would not)."""
    checks = [F.when(r.failure(), F.lit(r.target)) for r in rules if r.failure() is not None]
    return F.concat_ws(",", *checks) if checks else F.lit("")


def apply_rules(df: DataFrame, rules: list[ColumnRule], keep: list[str] = (),
                track_rejects: bool = False) -> DataFrame:
    """One projection: every rule's output plus the ``keep`` columns.

    With ``track_rejects`` a string column has :func:`failed_targets`."""
    cols = [r.expression().alias(r.target) for r in rules]
    cols += [F.col(k) for k in keep]
    if track_rejects:
        cols.append(failed_targets(rules).alias(REJECT_COLUMN))
    return df.select(*cols)


def parse_column_mapping(text: str | None) -> dict[str, str]:
    """``{"SOURCE_COL": "target_col", ...}`` in order; NULL/empty -> {}."""
    if not text or not text.strip():
        return {}
    mapping = json.loads(text)
    if not isinstance(mapping, dict) or not all(isinstance(k, str) and isinstance(v, str)
                                                for k, v in mapping.items()):
        raise ValueError("column mapping must be a JSON object of strings")
    return dict(mapping)


def rules_from_mapping(mapping: dict[str, str], kind: str = "text") -> list[ColumnRule]:
    return [ColumnRule(target=t, source=s, kind=kind) for s, t in mapping.items()]


def parse_transformation_rules(text: str | None) -> list[ColumnRule]:
    """JSON list of objects with keys ``target``, ``rule`` and, by kind,
    ``source``, ``type``, ``columns`` or ``value``."""
    if not text or not text.strip():
        return []
    items = json.loads(text)
    if not isinstance(items, list):
        raise ValueError("transformation rules must be a JSON list")
    out = []
    for it in items:
        unknown = set(it) - {"target", "source", "rule", "type", "columns", "value"}
        if unknown:
            raise ValueError(f"unknown rule keys {sorted(unknown)}")
        out.append(ColumnRule(target=it["target"], source=it.get("source"),
                              kind=it.get("rule", "text"), data_type=it.get("type"),
                              args=tuple(it.get("columns", ())), value=it.get("value")))
    return out


def rules_from_metadata(column_mapping: str | None, transformation_rules: str | None) -> list[ColumnRule]:
    """Mapping gives trimmed renames; a rule with the same target replaces the
    mapped one in place, other rules are appended in their order."""
    base = rules_from_mapping(parse_column_mapping(column_mapping))
    extra = parse_transformation_rules(transformation_rules)
    by_target = {r.target: r for r in extra}
    merged = [by_target.pop(r.target, r) if r.target in by_target else r for r in base]
    for r in extra:
        if r.target in by_target:
            merged.append(r)
            by_target.pop(r.target)
    return merged
