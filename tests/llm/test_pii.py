import hashlib
import re

from pyspark.sql import functions as F

from layerflow.llm import pii

DIR = "/root/testdata/sf0.01"
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "email":
        return True
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and luhn(d)
    return 10 <= len(d) <= 15


def brute(text):
    out = []
    for k, kind in enumerate(KINDS):
        out += [(m.start(), k, m.end()) for m in re.finditer(PATTERNS[kind], text or "") if good(kind, m[0])]
    return sorted(out)


ODD = [None, "", " ", "a@b.c_d@e.f x@y", "é a.b+c@d-e.fr, +1 (017) 555-7713.", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004",
       "4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111", "+49.30.1234567 +1 +22222222222222222", "1" * 3000,
       "x" * 5000, "+1" * 500, "a.b@" * 300 + "c.d", ("mail me: u1@h.org 10.0.0.1 " * 700) + "end", "😀 u@h.io 😀 1.1.1.1",
       "jo [at] ex [dot] org", "a@b.c" * 400, "1 2 3 4 5 6 7 8 9 " * 2000, "1.1.1.1" + ".1" * 3000]


def check(rows, texts):
    for r in rows:
        base = brute(texts[r["doc_id"]])
        got = [(x["s"], x["k"], x["e"]) for x in r["spans"] if x["base"]]
        assert got == base, r["doc_id"]


def test_base_spans_match_brute_force_on_odd_texts(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "doc_id long, text string, s string")
    check(pii.detect(df, pii.Model()).collect(), dict(enumerate(ODD)))


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    rows = pii.op7_pii(spark, DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        said = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r[f"n_{x}"] for x in KINDS] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(filter(None, said.split(","))) <= set(r["spans"].split(","))


def test_wide_spans_redact_and_empty(spark):
    texts = {1: "a u@h.io b 1.1.1.1 c", 2: None, 3: "please call (313) 555-0101 today", 4: "write to bo [at] mail [dot] org ok",
             5: "order 313 555 0101 is here, version 313.555.0101", 6: "999.1.1.1 4111111111111112 +12"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    model = pii.fit(df)
    spans = pii.detect(df, model)
    out = df.join(spans, "doc_id").select("doc_id", pii.redact(F.col("text"), F.col("spans")).alias("t")).collect()
    got = {r["doc_id"]: r["t"] for r in out}
    assert got[1] == "a [PII] b [PII] c" and got[3] == "please call [PII] today" and got[4] == "write to [PII] ok"
    assert got[2] is None and got[5] == texts[5] and got[6] == texts[6]
    empty = df.limit(0)
    assert pii.detect(empty, pii.fit(empty)).count() == 0
