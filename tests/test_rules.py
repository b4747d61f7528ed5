import pytest

from layerflow.functions.rules import (ColumnRule, parse_column_mapping,
                                       parse_transformation_rules, rules_from_metadata)


def test_mapping_and_rules_merge_in_place():
    rules = rules_from_metadata('{"A": "a", "B": "b"}',
                                '[{"target": "b", "source": "B", "rule": "cast", "type": "int"},'
                                ' {"target": "c", "source": "A", "rule": "flag"}]')
    assert [(r.target, r.kind) for r in rules] == [("a", "text"), ("b", "cast"), ("c", "flag")]


def test_empty_metadata():
    assert parse_column_mapping(None) == {} and parse_transformation_rules("  ") == []


def test_bad_rules_rejected():
    with pytest.raises(ValueError):
        ColumnRule("x", "X", "eval")
    with pytest.raises(ValueError):
        parse_transformation_rules('[{"target": "x", "sql": "1"}]')
    with pytest.raises(ValueError):
        parse_column_mapping('["a"]')
    with pytest.raises(ValueError):
        ColumnRule("x", "X", "cast")
