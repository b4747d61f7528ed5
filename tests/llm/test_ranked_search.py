import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from layerflow.llm import ranked_search as rs

PATTERN = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, top=20):
    """[(item_id, rank, doc_id, score)] by the formula, every document for every item."""
    terms = [(d, Counter(w), len(w)) for d, t in docs if (w := PATTERN.findall((t or "").translate(UPPER)))]
    n, total = len(terms), sum(k for _, _, k in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    out = []
    for i, text in items:
        found = []
        for d, c, k in terms:
            m = 75 + (25 * k * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in PATTERN.findall((text or "").translate(UPPER)) if t in c)
            if s > 0:
                found.append((-s, d is None, d))
        found.sort(key=lambda x: x if x[2] is not None else (*x[:2], 0))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(found[:top])]
    return out


def rows_of(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_docs,block_terms,evaluate", [(16_384, 200_000, 64), (7, 30, 3)])
def test_equals_scoring_every_document(spark, monkeypatch, block_docs, block_terms, evaluate):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(60)] + ["Über", "ÜBER", "naïve", "日本", "a1"]
    weights = [1 / (k + 1) for k in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.randint(0, 60))) for _ in range(300)]
    docs = [(k, t) for k, t in enumerate(texts)] + [(1000 + k, texts[5]) for k in range(40)] + [(2000, None), (2001, "-- ,,"), (None, texts[9])]
    items = [(k, ", ".join(rng.choices(words, k=rng.randint(1, 80)))) for k in range(15)] + [(90, None), (91, "zzz"), (92, texts[5].upper())]
    for name, value in (("BLOCK_DOCS", block_docs), ("EVALUATE", evaluate)):
        monkeypatch.setattr(rs, name, value)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(rs.search(d, i, block_terms=block_terms)) == sorted(brute(docs, items), key=str)


def test_odd_rows(spark):
    docs = [("b", "x y", 1), ("a", "x y", 1), ("a", "x y", 1), (None, "x y", 1), ("c", "x " * 300_000, 1), ("d", None, 1), ("e", "q", 1), ("f", "r", 1)]
    d = spark.createDataFrame(docs, "doc_id string, text string, score int")
    i = spark.createDataFrame([(1, "X!"), (1, "X!"), (2, "y"), (2, "q")], "item_id long, text string")
    got = rows_of(rs.search(d, i))
    want = sorted(brute([r[:2] for r in docs], [(1, "X!"), (2, "y"), (2, "q")]), key=str)
    assert got == want and sum(r[0] == 1 for r in got) == 5
    assert rs.search(d.limit(0), i).count() == 0 and rs.search(d, i.limit(0)).count() == 0
    assert rs.search(d.where("text IS NULL"), i).count() == 0


def test_masks_of_any_number_of_terms_are_told_apart():
    rng = np.random.default_rng(1)
    for terms in (3, 64, 65, 200):
        bits = rng.integers(0, 2, (terms, 50)).astype(np.uint8)
        bits = np.concatenate([bits, bits[:, :20]], axis=1)
        group, first = rs.grouped(np.packbits(bits, axis=0))
        columns = [bits[:, k].tobytes() for k in range(70)]
        assert len(first) == len(set(columns))
        assert all(columns[first[g]] == c for g, c in zip(group, columns))


def test_only_few_documents_are_evaluated(monkeypatch):
    """The masks end the evaluation early: most documents of a block are never scored."""
    rng = np.random.default_rng(2)
    ids, counts = [], []
    for _ in range(2000):
        own = np.flatnonzero(rng.random(30) < 1 / np.arange(2, 32)) + 1
        ids += own.tolist()
        counts.append(len(own))
    block = rs.Block(ids, counts, [20] * 2000, 2000, 40_000)
    seen = []
    kept = rs.Best(20)
    add = kept.add
    kept.add = lambda s, d: seen.extend(d) or add(s, d)
    block.best(list(range(1, 31)), [100 * k for k in range(1, 31)], kept, list(range(2000)))
    assert len(kept.rows) == 20 and len(seen) < 400
