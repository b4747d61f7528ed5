import zlib

import numpy as np

from layerflow.llm import langid

DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.collect()}
    rows = langid.op9_langid(spark, DIR).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    right = sum(r["lang_pred"] == truth[r["doc_id"]][0] for r in held)
    assert right >= 0.93 * len(held), right / len(held)


def test_grams_are_the_presence_kernel():
    for a in ("", "a", "ab", "abcabc", "äß  x\ny"):
        t = " ".join(a.lower().split())
        assert len(langid.grams(a)) == len({t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)})


def test_batch_product_equals_kernel_scores():
    rng = np.random.default_rng(1)
    vocab = np.unique(np.concatenate([langid.grams("the cat"), langid.grams("der hund")]))
    m = langid.Model(["a", "b"], vocab, rng.normal(size=(len(vocab), 2)), np.array([0.1, -0.1]))
    texts = ["the dog", "", "hund der der", "x" * 50]
    for t, s in zip(texts, m.scores(texts)):
        g = set(langid.grams(t).tolist())
        want = sum((m.weights[i] for i, v in enumerate(vocab.tolist()) if v in g), np.zeros(2))
        assert np.allclose(s, want / np.sqrt(max(len(g), 1)) + m.bias)


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(1, None, "en"), (2, "12 34 !!", "en"), (3, "the cat sat on the mat", "en"), (4, "der hund und die katze", "de"),
         (4, "der hund und die katze", "de"), (5, "the " * 100000, None), (None, "the dog", "en")],
        "doc_id long, text string, lang string")
    model = langid.fit(df.selectExpr("doc_id AS key", "text", "lang"))
    out = langid.predict(df, model).collect()
    assert len(out) == 7
    got = {r["doc_id"]: r["lang_pred"] for r in out}
    assert got[1] == got[2] == "und" and got[4] == "de" and got[5] == "en" and got[None] == "en"
    none = langid.fit(df.limit(0).selectExpr("doc_id AS key", "text", "lang"))
    assert {r["lang_pred"] for r in langid.predict(df, none).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).count() == 0
