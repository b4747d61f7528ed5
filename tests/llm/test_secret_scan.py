import re

from layerflow.llm import secret_scan as ss

DIR = "/root/testdata/sf0.01"
TOKEN = r"(?<![A-Za-z0-9_+/\-])[A-Za-z0-9_+/\-]{16,}={0,2}"


def test_finds_planted_secrets_and_leaves_prose(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    rows = ss.op6_secrets(spark, DIR).collect()
    assert len(rows) == len(texts)
    planted = 0
    for r in rows:
        t = texts[r["doc_id"]] or ""
        assert r["n_candidates"] == len(re.findall(TOKEN, t))
        found = {tuple(map(int, x.split(":"))) for x in r["spans"].split(",") if x}
        want = {m.span(1) for m in re.finditer(r'token = "([0-9a-f]{40})"', t)}
        planted += len(want)
        assert want <= found
        assert all(re.search("[0-9]", t[a:b]) for a, b in found)
    assert planted > 5


def test_held_out_findings(spark):
    """The forest is right on findings that it has not seen."""
    import hashlib
    held = []
    for i in range(40):
        h = hashlib.sha256(f"held-{i}".encode()).hexdigest()
        held += [(f"password={h[:32]} x", 1), (f"commit {h[:40]} again", 0), (f"a characteristicallyword{'e' * (i % 5)} b", 0)]
    df = spark.createDataFrame([(t, "p", y) for t, y in held], "text string, path string, label int")
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = ss.scored(df, ss.fit(docs, path_col="source"), "path").collect()
    right = sum((any(p["secret"] for p in r["pieces"])) == bool(r["label"]) for r in rows)
    assert right >= 0.95 * len(rows)


def test_stage_redacts_and_keeps_odd_rows(spark):
    h = "0123456789abcdef0123456789abcdef01234567"
    df = spark.createDataFrame(
        [(1, f'é token = "{h}" b', None, 9, "p", 1), (2, None, "s", None, "q", 2), (3, "", "s", 0, None, 3),
         (3, "", "s", 0, None, 3), (4, "wort " * 20000, "s", 1, None, 4)],
        "doc_id long, text string, source string, n_chars long, pieces string, s int")
    out = {r["s"]: r for r in ss.secrets_stage(spark, df, "").collect()}
    assert out[1]["text"] == 'é token = "[SECRET]" b' and out[1]["n_chars"] == len(out[1]["text"])
    assert out[2]["text"] is None and out[3]["text"] == "" and out[1]["pieces"] == "p"
    assert out[4]["text"] == "wort " * 20000
    assert ss.secrets_stage(spark, df, "").count() == 5 and ss.secrets_stage(spark, df.limit(0), "").count() == 0


def test_dictionary_counts_all_documents(spark):
    """Each of a few documents among many brings its own word often enough to be listed."""
    rare = ["qxw", "zkj", "vqh", "jxz", "wqk", "xhq", "kzv", "hjq", "qvz", "zxk"]
    rows = [(k, "eine lange zeile") for k in range(8000)] + [(9000 + k, (w + " ") * 20) for k, w in enumerate(rare)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert set(rare) <= set(ss.dictionary(df))
