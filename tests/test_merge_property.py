"""MERGE against a plain model: matched -> source row, unmatched source ->
insert, unmatched target -> kept, NULL keys never match."""

import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from layerflow.operators.publish import MergeCardinalityError, publish

KEYS = st.one_of(st.none(), st.integers(0, 6))


def _model(target, source):
    """Target keys may repeat, source keys too unless a target row has them."""
    new = dict((k, v) for k, v in source if k is not None)
    keys = {k for k, _ in target if k is not None}
    out = [(k, new[k]) if k in new else (k, v) for k, v in target]
    added = [s for s in source if s[0] is None or s[0] not in keys]
    return sorted(out + added, key=repr), len(added), sum(k in new for k, _ in target)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=st.lists(st.tuples(KEYS, st.integers(0, 9)), max_size=8),
       source=st.lists(st.tuples(KEYS, st.integers(10, 19)), max_size=8),
       narrow=st.booleans(), broadcast=st.booleans())
def test_merge_matches_model(spark, ws, target, source, narrow, broadcast):
    keys = {k for k, _ in target if k is not None}
    ambiguous = {k for k, _ in source if k in keys and sum(s[0] == k for s in source) > 1}
    schema, conf = "k int, v int", "spark.sql.autoBroadcastJoinThreshold"
    name = ws.name("prop_" + uuid.uuid4().hex[:10])
    publish(spark, spark.createDataFrame(target, schema), name, "MERGE", "k",
            root=ws.table_root(name.split(".")[1]))
    old = spark.conf.get(conf)
    spark.conf.set(conf, old if broadcast else "-1")
    try:
        if ambiguous:
            with pytest.raises(MergeCardinalityError):
                publish(spark, spark.createDataFrame(source, schema), name, "MERGE", "k", narrow=narrow)
            rows = sorted(target, key=repr)
        else:
            res = publish(spark, spark.createDataFrame(source, schema), name, "MERGE", "k", narrow=narrow)
            rows, inserted, updated = _model(target, source)
            assert (res.records_read, res.records_inserted, res.records_updated) == (len(source), inserted, updated)
    finally:
        spark.conf.set(conf, old)
    assert sorted((tuple(r) for r in spark.table(name).collect()), key=repr) == rows
