import zlib

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from layerflow.llm import packing

DIR = "/root/testdata/sf0.01"


def check(rows, texts, window=2048):
    """Against the tokenizer's own file: every id in exactly one piece, sequences without gaps."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in texts.items()}
    pieces, seqs = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(ids)
    for i, ps in pieces.items():
        at = 0
        for r in sorted(ps, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[i]) and r["length"] > 0
            part = np.array(ids[i][at:at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids[i])
    for ps in seqs.values():
        at = 0
        for r in sorted(ps, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    return sum(map(len, ids.values())), len(seqs)


def test_query_holds_every_id_once_with_little_padding(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    total, n = check(packing.op8_packing(spark, DIR).collect(), texts)
    assert n <= total / 2048 + 2


def test_odd_rows_and_small_shards(spark):
    texts = {1: None, 2: "", 3: "a <|endoftext|> b", 4: "word " * 30000, 5: "é😀\n\n  x", 6: "x" * 5000, 7: " " * 4000}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()] + [(2**60, "big id", 1)], "doc_id long, text string, ids int")
    texts[2**60] = "big id"
    check(packing.digests(packing.pack(df, shard_tokens=512, window=256)).collect(), texts, 256)
    assert packing.pack(df.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "a b c")] * 3 + [(None, "q")], "doc_id long, text string")
    rows = packing.pack(same).collect()
    assert len(rows) == 4 and sum(r["doc_id"] is None for r in rows) == 1


def test_neighbours_are_the_lexically_close_ones():
    rng = np.random.default_rng(3)
    tails = [rng.integers(1000 * (k % 2), 1000 * (k % 2) + 300, 100).astype(np.uint16) for k in range(20)]
    index = packing.Index(tails, np.ones(1 << 16, np.float32), 100.0)
    brute = np.zeros(20)
    for t in index.query[0]:
        for k, d in enumerate(tails):
            tf = (d == t).sum()
            brute[k] += tf * (packing.K1 + 1) / (tf + packing.K1) if tf else 0
    assert np.allclose(index.scores(0), brute, rtol=1e-4)
    for w in list(packing.fill(np.full(20, 100), index.scores, 400))[:2]:
        assert len({k % 2 for k, _, _ in w}) == 1 and sum(n for _, _, n in w) == 400


def test_planted_neighbours_share_windows_with_many_shards(spark):
    """40 topics of 12 texts each, in about 40 shards: windows hold one topic, whatever the order of the rows."""
    import random
    rng = random.Random(4)
    letters = "bcdfghklmnprstvz"
    words = ["".join(rng.choice(letters) + rng.choice("aeiou") for _ in range(3)) for _ in range(2400)]
    rows = []
    for k in range(480):
        own = words[60 * (k % 40):60 * (k % 40) + 60]
        rows.append((k, " ".join(rng.choice(own if rng.random() < 0.7 else words[:200]) for _ in range(60))))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    pieces = packing.pack(df, window=512, shard_tokens=1800).collect()
    check(packing.digests(packing.pack(df, window=512, shard_tokens=1800)).collect(), dict(rows), 512)
    total = sum(len(p["ids"]) // 4 for p in pieces)
    assert total > 30 * 1800
    windows = {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append(p["doc_id"] % 40)
    same = sum(w.count(max(set(w), key=w.count)) for w in windows.values() if len(w) > 1)
    of = sum(len(w) for w in windows.values() if len(w) > 1)
    assert same > 0.6 * of, (same, of)


def test_every_term_of_a_seed_is_asked():
    """Neighbours that share light terms only, beyond any number of heavy ones."""
    tails = [np.arange(k * 1000, k * 1000 + 200).astype(np.uint16) for k in range(12)]
    tails[7] = np.concatenate([tails[7], np.arange(170, 200)]).astype(np.uint16)
    idf = np.ones(1 << 16, np.float32)
    idf[170:200] = 0.1
    s = packing.Index(tails, idf, 200.0).scores(0)
    assert s[7] > 0 and sorted(np.argsort(-s)[:2].tolist()) == [0, 7]


VOCAB = public_tokenizers.path("byte_bpe_50k.tiktoken")
QUICK = packing.tokenizer(VOCAB)
PLAIN = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=QUICK._mergeable_ranks,
                          special_tokens=QUICK._special_tokens)
PARTS = [" ", "  ", "\n", "\t", "\r", "\x85", "\x1c", "\u00a0", "\u2028", "\u200b", "\u3000", "a", "S", "é", "e\u0301", "中", "😀", "'", "'s",
         "'ll", "'re", "'S", "1", "٣", "½", ".", "_", packing.SPECIAL[0]]


@settings(max_examples=1500, deadline=None)
@given(st.one_of(st.text(), st.lists(st.sampled_from(PARTS), max_size=12).map("".join)))
def test_the_quicker_pattern_gives_the_same_ids(text):
    assert packing.PATTERN != public_tokenizers.PATTERN
    assert np.array_equal(packing.encode(QUICK, text), packing.encode(PLAIN, text))


def test_terms_of_many_documents_at_once():
    rng = np.random.default_rng(8)
    docs = [rng.integers(0, 1 << 16, n).astype(np.uint16) for n in [1, 5000, 300, 1, 70000]] + [np.array([65535, 0, 65535], np.uint16)]
    assert packing.document_terms(docs).tolist() == [t for d in docs for t in sorted(set(d.tolist()))]
    many = [np.array([1, k % 7], np.uint16) for k in range(1 << 16)]
    assert np.bincount(packing.document_terms(many))[1] == 1 << 16
