import numpy as np
import regex

from layerflow.llm import decontam

DIR = "/root/testdata/sf0.01"


def words(t):
    return regex.findall(r"[\p{L}\p{M}\p{N}]+", (t or "").lower())


def bag(w):
    size = min(5, len(w))
    out = {}
    for k in range(len(w) - size + 1):
        s = tuple(w[k:k + size])
        out[s] = out.get(s, 0) + 1
    return out


def sim(a, b):
    both = sum(min(n, b.get(s, 0)) for s, n in a.items())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


def brute(docs, items):
    out = {}
    for d, t in docs:
        w = words(t)
        for i, x in items:
            y = words(x)
            if y and not (set(bag(y)) & set(bag(w)) if len(y) >= 5 else {1}):
                continue
            for s in range(len(w) - len(y) + 1 if y else 0):
                v = sim(bag(w[s:s + len(y)]), bag(y))
                if v >= 0.8:
                    out[d, i] = max(out.get((d, i), 0), v)
    return out


def test_query_matches_all_windows_by_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontam.op1_decontam(spark, DIR).collect()}
    want = brute(docs, items)
    assert set(got) == set(want) and len(got) > 5
    assert all(abs(got[k] - want[k]) < 1e-5 for k in got)


def test_radius_finds_all_fingerprints():
    """The Hamming blocks miss no fingerprint within the radius."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    for p in base[:60]:
        q = p
        for b in rng.choice(64, decontam.RADIUS, replace=False):
            q ^= np.uint64(1) << np.uint64(b)
        same = [int(a[0]) == int(b[0]) for a, b in zip(decontam.blocks(np.array([p]), decontam.RADIUS),
                                                       decontam.blocks(np.array([q]), decontam.RADIUS))]
        assert any(same) and len(same) == decontam.RADIUS + 1


def test_near_copies_and_odd_rows(spark):
    rng = np.random.default_rng(7)
    vocab = [f"w{k}" for k in range(400)]
    item = [vocab[k] for k in rng.integers(0, 400, 60)]
    near = item[:30] + ["changed"] + item[31:]
    far = [w if k % 4 else "other" for k, w in enumerate(item)]
    fillers = [vocab[k] for k in rng.integers(0, 400, 50)]
    text = lambda w: " ".join(fillers + w + fillers)
    docs = [(1, text(item)), (2, text(near)), (3, text(far)), (4, None), (5, ""), (6, text(item).upper().replace(" ", ",\n")),
            (7, " ".join(fillers * 2000 + item)), (1, text(near)), (None, text(item)), (8, "short one"), (9, "a, b -- c d")]
    items = [(1, " ".join(item)), (2, " ".join(item)), (3, None), (4, ""), (5, "b c d"), (6, " ".join(item[:40]))]
    d = spark.createDataFrame([(*x, 1, "k") for x in docs], "doc_id long, text string, item_id int, similarity string")
    i = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    for block in (1_000_000, 50):
        got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(d, i, block_words=block).collect()}
        want = {(a, b) for a in (1, 2, 6, 7, None) for b in (1, 2)} | {(a, 6) for a in (1, 2, 6, 7, None)} | {(9, 5)}
        assert want - {(2, 6)} <= got <= want
    assert decontam.find_leaks(d.limit(0), i).count() == 0 and decontam.find_leaks(d, i.limit(0)).count() == 0


def test_windows_of_other_lengths_are_not_fingerprinted(monkeypatch):
    """A passage of one item is looked up at that item's length only, not at the length of every item."""
    rng = np.random.default_rng(11)
    items = [(str(n), " ".join(f"i{n}x{k}" for k in range(n))) for n in range(3, 60)]
    bench = decontam.Benchmark(items, decontam.SIMILARITY, decontam.RADIUS)
    made = []
    real = decontam.window_prints
    monkeypatch.setattr(decontam, "window_prints", lambda h, s, width: made.append(len(s)) or real(h, s, width))
    fillers = [f"f{k}" for k in rng.integers(0, 99, 40)]
    text = " ".join(fillers + items[-1][1].split() + fillers)
    assert list(bench.matches(text)) == [("59", 40, 59, 1.0)]
    assert 0 < sum(made) < 30


def test_shingles_shared_by_items_of_many_lengths():
    """Items that are parts of each other, at several lengths, as brute force finds them."""
    rng = np.random.default_rng(13)
    base = [f"b{k}" for k in rng.integers(0, 12, 40)]
    items = [(f"{a}-{n}", " ".join(base[a:a + n])) for n in (1, 3, 4, 5, 6, 9, 17, 30) for a in (0, 4, 10)]
    changed = base[:15] + ["other"] + base[16:]
    docs = [(str(k), " ".join(w)) for k, w in enumerate([base, changed, base[::-1], base[5:25] * 3, base[:4], []])]
    bench = decontam.Benchmark(items, decontam.SIMILARITY, decontam.RADIUS)
    got = {(d, i): x for d, t in docs for i, _, _, x in bench.matches(t)}
    want = brute(docs, items)
    assert set(got) == set(want) and len(got) > 50
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
