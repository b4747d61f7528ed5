from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.operators import tables as tb
from layerflow.operators.publish import publish
from layerflow.operators.update import add_column_with_backfill, update_rows, update_table

SCHEMA = T.StructType([T.StructField("k", T.StringType(), False),
                       T.StructField("v", T.IntegerType()), T.StructField("flag", T.StringType())])


def partition_fragments(spark, name):
    """Partitions as ``SHOW PARTITIONS`` prints them (``a=1/b=x%2Fy``)."""
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def test_not_null_enforced_on_append_and_table_unchanged(spark, ws):
    name = ws.name("nn")
    tb.create_table(spark, name, SCHEMA, ws.table_root("nn"), comment="it's keyed")
    publish(spark, spark.createDataFrame([("a", 1, None)], SCHEMA), name, "APPEND")
    bad = spark.createDataFrame([("b", 2, None), (None, 3, None)], "k string, v int, flag string")
    with pytest.raises(Exception, match="NOT NULL"):
        publish(spark, bad, name, "APPEND")
    assert [r.k for r in spark.table(name).collect()] == ["a"]


def test_update_where_null_predicate_keeps_row(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", None, "y")], "k string, v int, flag string")
    out = update_rows(df, {"flag": F.lit("z")}, F.col("v") > 0).orderBy("k").collect()
    assert [r.flag for r in out] == ["z", "y"]
    assert [r.flag for r in update_rows(df, {"flag": F.lit("q")}).collect()] == ["q", "q"]


def test_update_table_counts_and_snapshot_switch(spark, ws):
    name = ws.name("u")
    publish(spark, spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)], SCHEMA),
            name, "APPEND", root=ws.table_root("u"))
    loc0 = tb.table_location(spark, name)
    n = update_table(spark, name, {"flag": F.lit("hit")}, F.col("k").isin("a", "c"))
    assert n == 2 and tb.table_location(spark, name) != loc0
    assert sorted((r.k, r.flag) for r in spark.table(name).collect()) == [
        ("a", "hit"), ("b", "y"), ("c", "hit")]


def test_add_column_and_backfill(spark, ws):
    name = ws.name("g")
    publish(spark, spark.createDataFrame([("a", 1, "x")], SCHEMA), name, "APPEND",
            root=ws.table_root("g"))
    tb.add_column(spark, name, "grp", "string", "DIMENSION or FACT")
    publish(spark, spark.createDataFrame([("b", 2, "y", "FACT")], "k string, v int, flag string, grp string"),
            name, "APPEND")
    assert add_column_with_backfill(spark, name, "grp", "string", "DIMENSION") == 1
    assert sorted((r.k, r.grp) for r in spark.table(name).collect()) == [("a", "DIMENSION"), ("b", "FACT")]


def test_partitioned_table_prunes(spark, ws):
    name = ws.name("p")
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    tb.create_table(spark, name, o.schema, ws.table_root("p"), partition_by=["o_orderstatus"])
    publish(spark, o, name, "APPEND")
    q = spark.table(name).filter(F.col("o_orderstatus") == "O").select("o_orderkey")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan
    assert q.count() == o.filter("o_orderstatus = 'O'").count()
    # a rewrite keeps the partition layout
    update_table(spark, name, {"o_orderpriority": F.lit("X")}, F.col("o_orderstatus") == "F")
    assert spark.table(name).count() == o.count()


def test_bad_names_rejected():
    with pytest.raises(ValueError):
        tb.check_name("a.b; DROP TABLE x")
    assert tb.sql_string("it's a \\ test") == "'it\\'s a \\\\ test'"


def _files(spark, name):
    """Data files by partition folder."""
    out = {}
    for f in spark.table(name).inputFiles():
        out.setdefault(unquote(f.rsplit("/", 2)[-2]), set()).add(f.rsplit("/", 1)[-1])
    return out


def _row_set(spark, n):
    return sorted(str(sorted(r.asDict().items())) for r in spark.table(n).collect())


def test_partition_scoped_merge(spark, ws):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    name = ws.name("op")
    tb.create_table(spark, name, o.schema, ws.table_root("op"), partition_by=["o_orderstatus"])
    publish(spark, o, name, "APPEND")
    before = _files(spark, name)
    src = (o.filter("o_orderstatus = 'P'").withColumn("o_orderpriority", F.lit("0-NOW"))
           .unionByName(spark.createDataFrame([(10**9, 1, "Q/x", 1.0, None, "new")], o.schema)))
    n_p = o.filter("o_orderstatus = 'P'").count()
    for narrow, counts in ((False, (1, n_p)), (True, (0, n_p + 1))):
        res = publish(spark, src, name, "MERGE", ["o_orderstatus", "o_orderkey"], narrow=narrow)
        assert res.strategy == "partitions" and (res.records_inserted, res.records_updated) == counts
    after = _files(spark, name)
    for part in ("o_orderstatus=F", "o_orderstatus=O"):     # not rewritten
        assert after[part] == before[part]
    assert not after["o_orderstatus=P"] & before["o_orderstatus=P"] and "o_orderstatus=Q%2Fx" in after
    t = spark.table(name)
    assert t.count() == o.count() + 1
    assert t.filter("o_orderpriority = '0-NOW'").count() == n_p
    assert t.filter("o_orderstatus = 'Q/x'").count() == 1


def test_touched_partitions_prune_the_scan(spark, ws):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    name = ws.name("dpp")
    tb.create_table(spark, name, o.schema, ws.table_root("dpp"), partition_by=["o_orderstatus"])
    publish(spark, o, name, "APPEND")
    touched = tb.touched_table(o.where("o_orderstatus = 'P'"), ["o_orderstatus"])
    path = ws.table_root("dpp_touched")
    touched.write.parquet(path)
    plan = tb.in_partitions(spark.table(name), spark.read.parquet(path), ["o_orderstatus"])
    assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == o.where("o_orderstatus = 'P'").count()


def test_partition_scoped_update(spark, ws):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    name = ws.name("up")
    tb.create_table(spark, name, o.schema, ws.table_root("up"), partition_by=["o_orderstatus"])
    tb.append_rows(spark, name, o)
    before = _files(spark, name)
    # matches rows of partition P only; the predicate column is also assigned
    n = update_table(spark, name, {"o_orderpriority": F.lit("0-NOW")},
                     (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"))
    want = o.filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").count()
    assert n == want > 0
    after = _files(spark, name)
    assert after["o_orderstatus=F"] == before["o_orderstatus=F"] and after["o_orderstatus=P"] != before["o_orderstatus=P"]
    t = spark.table(name)
    assert t.count() == o.count() and t.filter("o_orderpriority = '0-NOW'").count() == want
    # no match: nothing is written
    assert update_table(spark, name, {"o_orderpriority": F.lit("z")}, F.col("o_orderkey") < 0) == 0
    assert _files(spark, name) == after
    assert update_table(spark, name, {"o_orderstatus": F.lit("X")}, "o_orderpriority = '0-NOW'") == want
    assert spark.table(name).filter("o_orderstatus = 'X'").count() == want
    assert spark.table(name).count() == o.count()


def test_update_without_a_match_writes_nothing(spark, ws):
    name = ws.name("nomatch")
    publish(spark, spark.createDataFrame([("a", 1, "x")], SCHEMA), name, "APPEND", root=ws.table_root("nomatch"))
    loc = tb.table_location(spark, name)
    assert update_table(spark, name, {"flag": F.lit("hit")}, F.col("k") == "zz") == 0
    assert tb.table_location(spark, name) == loc


def test_null_partition_rows_survive(spark, ws):
    """'' and NULL are one partition; a rewrite that touches it keeps its other rows."""
    schema = "k int, v string, p string"
    rows = [(1, "a", None), (2, "b", "x"), (9, "z", None)]
    for n, keys in enumerate((["k"], ["p", "k"])):
        name = ws.name(f"nullp{n}")
        df = spark.createDataFrame(rows, schema)
        tb.create_table(spark, name, df.schema, ws.table_root(f"nullp{n}"), partition_by=["p"])
        tb.append_rows(spark, name, df)
        publish(spark, spark.createDataFrame([(3, "c", "")], schema), name, "MERGE", keys)
        assert sorted((tuple(r) for r in spark.table(name).collect()), key=repr) == sorted(rows + [(3, "c", None)], key=repr)
        assert update_table(spark, name, {"p": F.lit("")}, F.col("p") == "x") == 1
        assert spark.table(name).where("p IS NULL").count() == 4 and "p=x" not in partition_fragments(spark, name)
        # and out of it again; a row that comes back does not bring old files with it
        assert update_table(spark, name, {"p": F.lit("y")}, F.col("p").isNull()) == 4
        publish(spark, spark.createDataFrame([(7, "n", None)], schema), name, "APPEND")
        assert sorted(r.k for r in spark.table(name).where("p IS NULL").collect()) == [7]
        assert spark.table(name).count() == 5


def test_expire_snapshots_keeps_what_is_read(spark, ws):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    for part in (["o_orderstatus"], []):
        name = ws.name(f"ex{len(part)}")
        tb.create_table(spark, name, o.schema, ws.table_root(name), partition_by=part)
        publish(spark, o, name, "APPEND")
        update_table(spark, name, {"o_orderpriority": F.lit("U")}, F.col("o_orderstatus") == "P")
        publish(spark, o.filter("o_orderstatus = 'F'"), name, "MERGE", ["o_orderstatus", "o_orderkey"])
        update_table(spark, name, {"o_totalprice": F.lit(1.0)})
        before = sorted(map(str, spark.table(name).collect()))
        assert tb.expire_snapshots(spark, name, older_than_seconds=3600) == []   # grace period
        gone = tb.expire_snapshots(spark, name, older_than_seconds=0)
        assert len(gone) == (0 if part else 3)      # a partitioned table stays in its folder
        spark.catalog.refreshTable(name)
        assert sorted(map(str, spark.table(name).collect())) == before
        assert tb.expire_snapshots(spark, name, older_than_seconds=0) == []


def test_replayed_stream_batch_is_not_appended_twice(spark, ws):
    from layerflow.streaming.landing import Landed, batch_appender
    o = spark.read.parquet("/root/testdata/sf0.001/region.parquet")
    a, b = (o.withColumn("source_file_name", F.lit(f"/drop/{x}.csv")) for x in "ab")
    name, n = ws.name("landed"), o.count()
    tb.create_table(spark, name, a.schema, ws.table_root("landed"))
    batch_appender(name)(a, 0)                # appended, then the driver dies before the checkpoint's commit
    landed = Landed()
    append = batch_appender(name, landed)     # the next run gets the same batch first
    append(a.unionByName(b), 0)
    assert spark.table(name).count() == 2 * n and landed.rows == n
    append(a.withColumn("source_file_name", F.lit("/drop/c.csv")), 1)
    assert spark.table(name).count() == 3 * n and landed.rows == 2 * n


@pytest.mark.parametrize("narrow", [True, False])
def test_partition_scoped_merge_on_non_key_partition(spark, ws, narrow):
    """Partitioned by segment, keyed by customer: rows move between partitions, a partition is emptied
    and dropped, untouched ones keep their files; rows equal an unpartitioned merge."""
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    part, flat = ws.name(f"cp_{narrow}"), ws.name(f"cf_{narrow}")
    tb.create_table(spark, part, c.schema, ws.table_root(f"cp_{narrow}"), partition_by=["c_mktsegment"])
    publish(spark, c, part, "APPEND")
    publish(spark, c, flat, "MERGE", "c_custkey", root=ws.table_root(f"cf_{narrow}"))
    before = _files(spark, part)
    moved = c.filter("c_mktsegment = 'HOUSEHOLD'").withColumn("c_mktsegment", F.lit("X/new"))
    changed = c.filter("c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 5000") \
        .withColumn("c_name", F.lit("changed"))
    new = spark.createDataFrame([(10**6, "n", 1, 1.0, "BUILDING")], c.schema)
    src = moved.unionByName(changed).unionByName(new)
    r1 = publish(spark, src, part, "MERGE", "c_custkey", narrow=narrow)
    r2 = publish(spark, src, flat, "MERGE", "c_custkey", narrow=narrow)
    assert r1.strategy == "partitions"
    assert (r1.records_inserted, r1.records_updated) == (r2.records_inserted, r2.records_updated)
    assert _row_set(spark, part) == _row_set(spark, flat)
    after = _files(spark, part)
    assert "c_mktsegment=HOUSEHOLD" not in partition_fragments(spark, part) and "c_mktsegment=X%2Fnew" in after
    for seg in ("FURNITURE", "MACHINERY"):
        assert after[f"c_mktsegment={seg}"] == before[f"c_mktsegment={seg}"]
    assert after["c_mktsegment=AUTOMOBILE"] != before["c_mktsegment=AUTOMOBILE"]


def test_partitioned_writes_make_few_files(spark, ws):
    """REBALANCE by partition column: each partition gets about one file,
    not one per shuffle task (8 here)."""
    from layerflow.operators.publish import publish
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").repartition(8)
    name = ws.name("ff")
    tb.create_table(spark, name, o.schema, ws.table_root("ff"), partition_by=["o_orderstatus"])
    publish(spark, o, name, "APPEND")
    publish(spark, o.withColumn("o_orderpriority", F.lit("x")), name, "MERGE",
            ["o_orderstatus", "o_orderkey"])
    files = spark.table(name).inputFiles()
    per_part = {}
    for f in files:
        d = f.rsplit("/", 2)[-2]
        per_part[d] = per_part.get(d, 0) + 1
    assert len(per_part) == 3 and max(per_part.values()) <= 2, per_part
    assert spark.table(name).filter("o_orderpriority = 'x'").count() == o.count()


def test_update_moving_rows_between_partitions(spark, ws):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    name, flat = ws.name("mv"), ws.name("mv_flat")
    tb.create_table(spark, name, o.schema, ws.table_root("mv"), partition_by=["o_orderstatus"])
    tb.create_table(spark, flat, o.schema, ws.table_root("mv_flat"))
    tb.append_rows(spark, name, o)
    tb.append_rows(spark, flat, o)
    before = _files(spark, name)
    for t in (name, flat):
        # P empties into the new partition Z; F and O hold no match
        assert update_table(spark, t, {"o_orderstatus": F.lit("Z")},
                            F.col("o_orderstatus") == "P") == o.filter("o_orderstatus = 'P'").count()
    after = _files(spark, name)
    assert "o_orderstatus=P" not in partition_fragments(spark, name) and "o_orderstatus=Z" in after
    assert after["o_orderstatus=F"] == before["o_orderstatus=F"]
    assert after["o_orderstatus=O"] == before["o_orderstatus=O"]
    assert _row_set(spark, name) == _row_set(spark, flat)
    # rows move into an existing partition that also keeps its own rows
    for t in (name, flat):
        update_table(spark, t, {"o_orderstatus": F.lit("F")}, F.col("o_orderpriority") == "1-URGENT")
    assert _row_set(spark, name) == _row_set(spark, flat)
