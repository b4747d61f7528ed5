import random
import re
import zlib
from collections import Counter

import pytest

from layerflow.llm import spelling as sp


def brute_counts(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            out[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return out


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(counts, min_length=6, min_count=5, ratio=5):
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    close = {w: [v for v in words if near(w, v)] for w in words}
    form = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in close.items() if vs}
    form = {w: f for w, f in form.items() if words[f] >= ratio * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(close[w]), words[form[w]] if w in form else None))
    return sorted(out)


def rows_of(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def test_word_counts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sp, "FLUSH_WORDS", 500)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    docs += [(None, "ÀÉabc ABCÿz ß×÷ Āabcdef ﬁabcdef"), (7, None), (7, ""), (8, "abcdef " * 50_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = Counter()
    for r in sp.word_counts(df, min_length=1).collect():
        got[r["word"]] += r["n"]
    want = brute_counts(docs)
    want.pop("", None)
    assert got == want


@pytest.mark.parametrize("alphabet,seed", [("ab", 1), ("abcé", 2), ("abcdefgh", 3)])
def test_variants_equal_comparing_all_words(spark, alphabet, seed):
    rng = random.Random(seed)
    counts = Counter()
    for _ in range(250):
        w = "".join(rng.choices(alphabet, k=rng.randint(5, 9)))
        counts[w] += rng.choice([1, 4, 5, 6, 25, 30, 31, 130, 700, 4000])
        for _ in range(2):  # a near one
            k = rng.randrange(len(w))
            v = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(alphabet) + w[k:], w[:k] + rng.choice(alphabet) + w[k + 1:]])
            counts[v] += rng.choice([1, 5, 6, 30, 200])
    rows = [x for w, n in counts.items() for x in ((w, n - n // 2), (w, n // 2))] + [(None, 9)]
    df = spark.createDataFrame(rows, "word string, n long").repartition(4)
    want = brute_variants(counts)
    assert rows_of(sp.group_variants(df)) == want
    assert any(r[1] and r[2] != r[1] for r in want)  # a chain


def test_each_pair_of_near_words_once_in_each_direction(spark):
    words = ["aaaa", "aaa", "aab", "aba", "a", "aaaaa", "b", "ab", "ba", "bb", "ÿa", "x\0y", "x\0z"]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = sorted((r["word"], r["near"]) for r in sp.near_words(df).collect())
    assert got == sorted((a, b) for a in words for b in words if near(a, b) and "\0" not in a + b)


def test_a_chain_of_forms_ends_at_its_root(spark):
    words = [("abcdefghij"[:k] + "Z" * (10 - k), 5 ** (k + 1)) for k in range(11)]
    rows = rows_of(sp.group_variants(spark.createDataFrame(words, "word string, n long")))
    assert rows == brute_variants(dict(words)) and {r[2] for r in rows} == {"abcdefghij"}


def test_ties_and_empty_tables(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaaac": 25, "aaaaaab": 25, "zzzzzz": 5}
    rows = rows_of(sp.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert rows == brute_variants(words) and rows[0][:3] == ("aaaaaa", "aaaaaab", "aaaaaab")
    none = spark.createDataFrame([], "doc_id long, text string, word string")
    assert sp.group_variants(sp.word_counts(none)).count() == 0
    with pytest.raises(ValueError):
        sp.group_variants(none, ratio=1)
