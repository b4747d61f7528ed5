import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from layerflow.llm import token_counts as tc

DIR = "/root/testdata/sf0.01"
VOCAB = public_tokenizers.path(tc.VOCAB)
LIBRARY = Tokenizer.from_file(VOCAB)
COUNTED = tc.Counted(VOCAB)


def brute(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_query_equals_the_library_on_whole_texts(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()}
    rows = tc.op13_token_counts(spark, DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text, n = texts[r["doc_id"]], brute(texts[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((text or "").encode()), n, n > 2048)
    assert any(r["over_limit"] for r in rows) and not all(r["over_limit"] for r in rows)


PARTS = st.one_of(st.text(max_size=12), st.sampled_from([
    " ", "\n", "\x0b", "\x0c", "\r", "\t", "\x1c", "\x85", " ", " ", "́", "é", "̈", "Σ", "ς",
    "İ", "ẞ", "<|endoftext|>", "<|startoftext|>", "<|END", "OFTEXT|>", "'s", "'LL", "don't", "1234", "½", "한", "ᄒ", "ᅡ",
    "</w>", "e", "é", "😀", "‍"]))


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=12))
def test_pieces_between_blanks_count_as_the_whole_text(parts):
    text = "".join(parts)
    assert COUNTED.count(text.encode()) == brute(text)


def test_cache_encodes_only_what_it_lacks(spark, folder, monkeypatch):
    cache, asked = f"{folder}/cache", []
    encode = tc.encoded
    monkeypatch.setattr(tc, "encoded", lambda texts, *a: asked.append(sorted(r["text"] for r in texts.collect())) or encode(texts, *a))
    first = spark.createDataFrame([(1, "a b"), (2, " a  b\n"), (3, "c"), (4, None), (5, "")], "doc_id long, text string")
    assert sorted(map(tuple, tc.token_counts(first, cache).collect()))[:3] == [(1, 3, 2, False), (2, 6, 2, False), (3, 1, 1, False)]
    assert len(asked[0]) == 3  # two contents and the empty one
    second = spark.createDataFrame([(6, "a\tb"), (7, "new one")] * 2, "doc_id long, text string")
    got = sorted(map(tuple, tc.token_counts(second, cache, limit=1).collect()))
    assert got == [(6, 3, 2, True)] * 2 + [(7, 7, 2, True)] * 2 and asked[1] == ["new one"]
    assert sorted(map(tuple, tc.token_counts(second, cache, limit=1).collect())) == got and asked[2] == []
    version = tc.version_digest(VOCAB)
    assert tc.stored_counts(spark, cache, version).count() == 4
    # rows that another run appended at the same time count once; another tokenizer has its own part
    spark.read.parquet(f"{cache}/tokenizer={version}").write.mode("append").parquet(f"{cache}/tokenizer={version}")
    assert sorted(map(tuple, tc.token_counts(second, cache, limit=1).collect())) == got
    assert tc.stored_counts(spark, cache, "other").count() == 0


def test_known_texts_do_not_move(spark, folder):
    """With few misses the semi join is planned below the aggregation, as a broadcast."""
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(50)], "doc_id long, text string")
    rows = docs.withColumn("content", tc.content_digest(docs["text"]))
    rows.limit(3).select("content").write.parquet(f"{folder}/misses")
    misses = spark.read.parquet(f"{folder}/misses")
    texts = rows.groupBy("content").agg({"text": "min"}).join(misses, "content", "left_semi")
    plan = texts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join LeftSemi")


def test_odd_rows(spark, folder):
    long = "word, " * 200_000
    rows = [(1, None, "x"), (None, "", "x"), (2, long, "x"), (2, long, "x"), (3, " \n\t ", "x"), (3, "<|endoftext|>", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, content string").withColumn("n_tokens", df_one())
    got = sorted(map(tuple, tc.token_counts(df, f"{folder}/c").collect()), key=str)
    want = sorted([(i, len((t or "").encode()), brute(t), brute(t) > 2048) for i, t, _ in rows], key=str)
    assert got == want
    assert tc.token_counts(df.limit(0), f"{folder}/c").count() == 0


def df_one():
    from pyspark.sql import functions as F
    return F.lit(1)


def test_a_full_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(tc, "MEMO", 2)
    counted = tc.Counted(VOCAB)
    for text in ("a b c d e f", "a b x", "f e d", ""):
        assert counted.count(text.encode()) == brute(text)
