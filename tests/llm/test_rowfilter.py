from pyspark.sql import functions as F

from layerflow.llm import decontam, rowfilter


def test_no_key_is_missed_and_few_others_pass(spark, monkeypatch):
    docs = spark.range(20_000).withColumn("_may", F.col("id") * 2)
    keys = spark.range(0, 20_000, 50).select(F.col("id").alias("k"))
    for bits in (rowfilter.MAX_BITS, 1 << 10):          # the second one is nearly full: all the same rows
        monkeypatch.setattr(rowfilter, "MAX_BITS", bits)
        hit, rest = rowfilter.split(docs, keys, F.xxhash64("k"), F.xxhash64("id"))
        assert hit.columns == docs.columns
        ids = {r.id for r in hit.collect()}
        assert ids >= set(range(0, 20_000, 50)) and len(ids) + rest.count() == 20_000
        assert bits == 1 << 10 or len(ids) < 2500
        assert hit.join(keys, F.col("id") == F.col("k"), "left_anti").unionByName(rest).count() == 19_600
    none, every = rowfilter.split(docs, keys.limit(0), F.xxhash64("k"), F.xxhash64("id"))
    assert none.count() == 0 and every.count() == 20_000


def test_a_leak_takes_no_other_text_with_it(spark):
    """Null and repeated ids: only rows with the leaking text go."""
    d = "/root/testdata/sf0.001"
    leak = spark.read.parquet(f"{d}/benchmark.parquet").first()["text"]
    rows = [(None, "before " + leak, "x"), (None, "clean text here", "x"), (7, leak, "x"), (7, "another clean text", "x"), (7, leak, "y"),
            (8, None, "x"), (None, None, "x"), (9, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, leak string")
    kept = decontam.decontam_stage(spark, docs, d)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([r for r in rows if not r[1] or leak not in r[1]], key=str)
    assert decontam.decontam_stage(spark, docs.limit(0), d).count() == 0
