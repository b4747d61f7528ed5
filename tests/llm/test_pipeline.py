import re

import duckdb
from test_decontam import brute as leaks_by_brute_force
from test_ngram_join import brute as groups_by_brute_force
from test_packing import check as check_pieces

import corpus_pipeline
from layerflow.llm import quality, secret_scan

DIR = "/root/testdata/sf0.01"
SECRET = r'(?<=token = ")[0-9a-f]{40}(?=")'


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    kept = {d for d, k in db.execute(f"SELECT doc_id, kept FROM ({quality.OP4_SQL})").fetchall() if k}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DIR)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.count() == len(after)
        if name == "quality rules":
            assert set(after) == kept
        elif name == "n-gram join":
            assert set(after) == {d for d, _, c in groups_by_brute_force(sorted(before.items())) if d == c}
        elif name == "benchmark decontamination":
            found = {d for d, _ in leaks_by_brute_force(list(before.items()), items)}
            assert set(after) == set(before) - found and found
        else:
            assert set(after) == set(before)
            for d, t in before.items():
                assert after[d] == re.sub(SECRET, secret_scan.MARK, t) or secret_scan.MARK in after[d]
                assert not re.search(SECRET, after[d])
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect() if secret_scan.MARK in r["text"])
        if name in ("quality rules", "n-gram join", "benchmark decontamination"):
            assert all(after[d] == before[d] for d in after)
        before = after
    check_pieces(corpus_pipeline.STAGES[-1][1](spark, docs, DIR).collect(), before)


def test_run_on_the_smallest_table(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and sum(r["length"] for r in rows if r["start"] == 0) > 0
