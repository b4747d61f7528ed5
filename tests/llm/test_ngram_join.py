import random
import re

import numpy as np
import pytest

from layerflow.llm import graph, ngram_join as nj


def shingles(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\x20\x09-\x0d]+", t)
    return {tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for k, (d, _) in enumerate(docs):
        ids = [docs[m][0] for m in range(len(docs)) if find(m) == find(k) and docs[m][0] is not None]
        out.append((d, len(sets[k]), d if not sets[k] else min(ids, default=None)))
    return sorted(out, key=str)


def run(spark, docs, parts=3):
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, entity int, n string").repartition(parts)
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in nj.near_components(df).collect()], key=str)


def copies(rng, vocab, words, n, edits):
    base = [rng.choice(vocab) for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        out.append(" ".join(w))
    return out


def test_matches_brute_force_on_near_copies_and_shared_passages(spark):
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(3000)]
    texts = []
    for words, n, edits in ((60, 12, 4), (200, 10, 6), (30, 8, 2), (8, 6, 1), (500, 6, 12)):
        texts += copies(rng, vocab, words, n, edits)
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    texts += [" ".join(rng.choice(vocab) for _ in range(40)) + " " + passage for _ in range(20)]
    texts += [" ".join(rng.choice(vocab[:4]) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    docs = list(enumerate(texts, 10))
    rng.shuffle(docs)
    assert run(spark, docs) == brute(docs)


@pytest.mark.parametrize("words,n,edits", [(60, 150, 3), (45, 620, 2)])
def test_frequent_tokens_meet_by_combination_and_blocks(spark, words, n, edits):
    """More copies than the rare class, and more than a block holds."""
    rng = random.Random(words)
    docs = list(enumerate(copies(rng, [f"w{k}" for k in range(3000)], words, n, edits)))
    assert run(spark, docs) == brute(docs)


def test_prefixes_meet_for_every_similar_pair():
    """The index alone misses no similar pair, whatever the classes and sizes."""
    rng = np.random.default_rng(5)
    base = [rng.choice(10**6, s, replace=False) for s in (5, 20, 60, 172, 199, 201, 230, 400)]
    sets = []
    for b in base:
        for _ in range(12):
            s = b.copy()
            s[rng.choice(len(s), rng.integers(0, max(2, len(s) // 9)), replace=False)] = rng.integers(10**6, 2 * 10**6)
            sets.append(np.unique(s))
    sets += [np.unique(np.concatenate([base[4], rng.integers(10**6, 10**7, rng.integers(1, 30))])) for _ in range(20)]
    token, count = np.unique(np.concatenate(sets), return_counts=True)
    for scale in (1, 50):  # all rare, then most of them frequent
        rows = [(k, len(s), int(t), int(count[np.searchsorted(token, t)]) * scale)
                for k, s in enumerate(sets) for t in s if count[np.searchsorted(token, t)] > 1]
        e, n, t, df = (np.array(x, np.int64) for x in zip(*rows))
        key, owner = nj.prefix_keys(e, n, t, df, 85)
        held = [set(key[owner == k].tolist()) for k in range(len(sets))]
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                alike = 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both)
                if alike and not np.array_equal(sets[i], sets[j]):
                    assert held[i] & held[j], (scale, len(sets[i]), len(sets[j]))


def test_similar_sets_share_enough_of_their_first_tokens():
    """What the first count relies on, for pairs right at the threshold too."""
    rng = np.random.default_rng(9)
    close = 0
    for _ in range(4000):
        n = int(rng.integers(2, 300))
        x = np.unique(rng.integers(0, 2**62, n))
        lost = int(rng.integers(0, max(2, n // 8)))
        y = np.unique(np.concatenate([rng.permutation(x)[lost:], rng.integers(0, 2**62, rng.integers(0, max(2, n // 8)))]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 85 * (len(x) + len(y) - both):
            continue
        close += 100 * both < 88 * (len(x) + len(y) - both)
        first = [s[:len(s) - nj.least_overlap(len(s), 85) + (len(s) + 9) // 10] for s in (x, y)]
        shared = len(np.intersect1d(*first))
        assert all(10 * shared >= nj.least_overlap(len(s), 85) for s in (x, y))
    assert close > 50


def test_filter_has_no_false_negatives(spark):
    rows = [(k * 7919 - 50, None if k % 9 == 0 else f"d{k}") for k in range(500)]
    df = spark.createDataFrame(rows, "entity long, doc_id string").repartition(5)
    both, alone = nj.filter_of(df), nj.filter_of(df.select("entity"))
    assert all(both.has(e, d) and alone.has(e) for e, d in rows)
    assert sum(alone.has(10**12 + k) for k in range(1000)) < 50


def test_odd_rows(spark):
    docs = [(5, None), (6, ""), (7, " \t\n"), (8, "One two"), (9, "one TWO"), (10, "one two x"), (2**60, "É a b c d"),
            (3, "é a b c d"), (4, "a\x85b c d e"), (None, "one two"), (1, "long " * 30000 + "end"), (2, "long " * 30000 + "end"),
            (11, "q w e r t y"), (11, "q w e r t y")]
    got = run(spark, docs)
    assert got == brute(docs)
    assert run(spark, [(None, "a b c d e"), (None, "a b c d e")]) == [(None, 2, None)] * 2
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert nj.near_components(empty).count() == 0


@pytest.mark.parametrize("share", [10, 100, 10**6])
def test_components_of_a_long_path_and_a_star(spark, share):
    path = [(k, k + 1) for k in range(300)]
    star = [(1000, 1001 + k) for k in range(500)]
    df = spark.createDataFrame(path + star + [(5, 5)], "a long, b long").repartition(7)
    assert graph.components(df.limit(0), share).count() == 0
    roots = {r["node"]: r["root"] for r in graph.components(df, share).collect()}
    assert all(roots[k] == 0 for k in range(1, 301)) and all(roots[k] == 1000 for k in range(1001, 1501))
    assert len(roots) == 800


def stage(spark, docs, **how):
    df = spark.createDataFrame([(*d, k) for k, d in enumerate(docs)], "doc_id long, text string, own_key long").repartition(3)
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in nj.near_duplicates_stage(spark, df, "", **how).collect())


def test_stage_decides_by_row(spark):
    """Equal rows, null ids, and other texts under an id that goes."""
    a, b, other = "a b c d e f g h", "A b c d  e f g h", "q w e r t y u i"
    null = (True, 0)
    assert stage(spark, [(1, a), (1, a), (1, a)]) == [(False, 1, a)]
    assert stage(spark, [(None, a), (None, a), (None, other)]) == [(*null, a), (*null, other)]
    assert stage(spark, [(None, a), (7, a), (9, a)]) == [(False, 7, a)]
    assert stage(spark, [(1, a), (2, a), (2, other)]) == [(False, 1, a), (False, 2, other)]
    assert len(stage(spark, [(3, a), (3, b), (3, a)])) == 1
    assert stage(spark, [(4, None), (4, None), (None, ""), (None, " ")]) == [(False, 4, "")] * 2 + [(*null, ""), (*null, " ")]


def test_stage_takes_other_shingles_and_thresholds(spark):
    """Pairs between 4-word 0.85 and 5-word 0.8 go only with the latter."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(300)]
    docs = []
    for k in range(40):
        w = rng.sample(base, 60)
        v = list(w)
        for at in rng.sample(range(60), rng.randint(0, 2)):
            v[at] = f"x{k}"
        docs += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]

    def groups(size, percent):
        sets = [{tuple(t.split()[i:i + size]) for i in range(61 - size)} for _, t in docs]
        return {d for k, (d, _) in enumerate(docs) if not any(
            100 * len(sets[k] & sets[j]) >= percent * len(sets[k] | sets[j]) for j in range(k))}

    assert groups(5, 80) != groups(4, 85)
    for how in ((5, 80), (4, 85)):
        assert {d for _, d, _ in stage(spark, docs, size=how[0], percent=how[1])} == groups(*how)


@pytest.mark.parametrize("block", [512, 7])
def test_pairs_are_all_links_between_different_texts(spark, monkeypatch, block):
    """Each once, also over several blocks, and not only as many as join them."""
    monkeypatch.setattr(nj, "BLOCK", block)
    rng = random.Random(17)
    vocab = [f"w{k}" for k in range(3000)]
    docs = list(enumerate(copies(rng, vocab, 120, 40, 2) + copies(rng, vocab, 60, 10, 1)))
    pairs, members = nj.near_pairs(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    entity = {r["doc_id"]: r["entity"] for r in members.collect()}
    sets = {entity[d]: shingles(t) for d, t in docs}
    names = sorted(sets)
    want = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert sorted((r["a"], r["b"]) for r in pairs.collect()) == want and len(want) > len(names)


@pytest.mark.parametrize("percent", [85, 80, 50, 34])
def test_no_link_of_small_and_of_less_similar_sets_is_lost(spark, percent, monkeypatch):
    """Sets of one to a few tokens, hubs that a hundred others share one token with, copies, more sets than a block."""
    monkeypatch.setattr(nj, "BLOCK", 16)
    monkeypatch.setattr(nj, "RARE", 8)
    rng = random.Random(percent)
    texts = ["a b c d"] + [f"a b c d e{k}" for k in range(60)] + [f"a b c d e{k} f{k % 3}" for k in range(30)]
    texts += copies(rng, [f"w{k}" for k in range(50)], 9, 40, 3) + copies(rng, ["x", "y"], 6, 30, 3)
    texts += ["a b c d"] * 3 + [None, "", "  ", "z"]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    sets = {d: set(nj.shingle_set(t).tolist()) for d, t in docs}
    want = {d: sum(e != d and bool(s & o) and 100 * len(s & o) >= percent * len(s | o) for e, o in sets.items())
            for d, s in sets.items()}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = nj.near_components(df, percent=percent).collect()
    assert {r["doc_id"]: r["n_links"] for r in rows} == want
    group = {d: d for d, _ in docs}
    for _ in docs:
        for d, s in sets.items():
            for e, o in sets.items():
                if s & o and 100 * len(s & o) >= percent * len(s | o):
                    group[d] = min(group[d], group[e])
        if all(group[d] == group[group[d]] for d in group):
            break
    assert {r["doc_id"]: r["component_id"] for r in rows} == group
