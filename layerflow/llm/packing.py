"""Lexical retrieval packing: documents are packed into windows next to lexically close ones.

Each document becomes token ids plus an end id.  Its first full windows stand alone; its tail is
packed.  Tails are dealt by content to shards of about ``SHARD_TOKENS`` tokens: a tail's weighted terms are
projected to ``DIMS`` numbers, its three nearest of at most ``CENTRES`` centres are its cell, and shards
are ranges of the cells in order (similar centres are next to each other), so close tails are in one
shard however many there are.  A cell larger than a shard is split by a hash.  Only the centres are
fitted on a sample.  Each shard has a BM25 inverted index of its tails, with document frequencies and
mean length over *all* documents, and is asked for all terms of a seed.  The longest unused tail seeds a window; the index returns unused neighbours by score, and
they fill the window in that order.  The one that no longer fits is cut there, and its rest seeds the
next window, so only the last window of a shard has padding.

The token table is written once below the shared folder: pieces and shards do not change when
executors are lost, and nothing is tokenised twice.  Term statistics have at most one row per id of
the vocabulary.

Defined results: a null or empty text is the end id alone; rows with equal ids are separate
documents; a null id stays null; texts of any length are cut; other columns are ignored; no documents:
no pieces.  The special string of the vocabulary inside a text becomes its id, as in the tokenizer's
own file.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import lean, sample_of, table
from layerflow.session import scratch_dir

WINDOW = 2048
END = 1
SHARD_TOKENS = 1 << 20
DIMS, CENTRES, MAX_CENTRE_TAILS = 64, 256, 8_000
K1, B = 1.2, 0.75
SPECIAL = ("<|endoftext|>", 50256)  # fixed value of the vocabulary
FLUSH_TOKENS = 4 << 20
#: ``public_tokenizers.PATTERN`` with fewer steps back: the same pieces of any text.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
COUNT_TOKENS = 1 << 18
SKETCH_TAILS = 256
FULL, TAIL, STATS = 0, 1, 2
SCHEMA = "kind int, row long, doc_id string, doc_tokens long, start long, sequence_id long, ids binary"


def tokenizer(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("pack", pat_str=PATTERN, mergeable_ranks=ranks,
                             special_tokens=dict([SPECIAL]))


def encode(enc: tiktoken.Encoding, text: str | None) -> np.ndarray:
    text = text or ""
    special = "all" if SPECIAL[0] in text else set()
    ids = enc.encode_to_numpy(text, allowed_special=special, disallowed_special=())   # no list of Python numbers
    out = np.empty(len(ids) + 1, np.uint16)  # the vocabulary has fewer than 65,536 ids
    out[:-1], out[-1] = ids, END
    return out


def document_terms(docs: list[np.ndarray]) -> np.ndarray:
    """The distinct ids of each of up to 65,536 documents, one after the other."""
    own = np.repeat(np.arange(len(docs), dtype=np.uint32), [len(d) for d in docs])
    pair = np.sort(own << 16 | np.concatenate(docs))
    return (pair[np.concatenate([[True], pair[1:] != pair[:-1]])] & 0xFFFF).astype(np.uint16)


def tokenized(docs: DataFrame, folder: str, id_col: str, text_col: str, vocab: str, window: int) -> DataFrame:
    """The token table: full windows, tails, and one row of term statistics per task."""
    if window < 2:
        raise ValueError("a window has at least two tokens")

    @lean
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, first = tokenizer(vocab), TaskContext.get().partitionId() << 33
        df, n_docs, n_tokens, row, seq = np.zeros(1 << 16, np.int64), 0, 0, first, first
        out: list[tuple] = []
        held, uncounted, some = 0, [], 0
        for p in parts:
            for doc_id, text in zip(p["doc_id"], p["text"]):
                ids = encode(enc, text)
                uncounted.append(ids)
                some += len(ids)
                if some >= COUNT_TOKENS or len(uncounted) == 1 << 16:
                    df += np.bincount(document_terms(uncounted), minlength=1 << 16)
                    uncounted, some = [], 0
                n_docs, n_tokens = n_docs + 1, n_tokens + len(ids)
                for at in range(0, len(ids), window):
                    cut = ids[at:at + window]
                    full = len(cut) == window
                    out.append((FULL if full else TAIL, row, doc_id, len(ids), at, 2 * seq if full else None, cut.tobytes()))
                    row, seq, held = row + 1, seq + full, held + len(cut)
                if held >= FLUSH_TOKENS:
                    yield pd.DataFrame(out, columns=COLUMNS).astype({"sequence_id": "Int64"})
                    out, held = [], 0
        if uncounted:
            df += np.bincount(document_terms(uncounted), minlength=1 << 16)
        if n_docs:
            terms = np.flatnonzero(df)
            out.append((STATS, row, None, n_docs, n_tokens, None, np.stack([terms, df[terms]]).tobytes()))
        if out:
            yield pd.DataFrame(out, columns=COLUMNS).astype({"sequence_id": "Int64"})

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    rows.mapInPandas(run, SCHEMA).write.option("compression", "zstd").parquet(f"{folder}/tokens")
    return docs.sparkSession.read.schema(SCHEMA).parquet(f"{folder}/tokens")


COLUMNS = ["kind", "row", "doc_id", "doc_tokens", "start", "sequence_id", "ids"]


def term_weights(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Inverse document frequency by id (at most 65,536), the same without the ids of a single document,
    and the mean length, over all documents."""
    stats = tokens.where(F.col("kind") == STATS)

    @lean
    def spread(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for b in p["ids"]:
                terms, df = np.frombuffer(b, np.int64).reshape(2, -1)
                yield pd.DataFrame({"term": terms, "df": df})

    total = stats.agg(F.sum("doc_tokens").alias("n"), F.sum("start").alias("tokens")).first()
    n, length = total["n"] or 0, (total["tokens"] or 0) / max(total["n"] or 0, 1)
    df = np.zeros(1 << 16)
    for r in stats.select("ids").mapInPandas(spread, "term long, df long").groupBy("term").agg(
            F.sum("df").alias("df")).toLocalIterator():
        df[r["term"]] = r["df"]
    idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)
    return idf, np.where(df > 1, idf, np.float32(0)), length


def projection() -> np.ndarray:
    return np.random.default_rng(5).standard_normal((1 << 16, DIMS), np.float32)


def sketches_of(tails: list[np.ndarray], shared_idf: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Each tail's weighted terms as ``DIMS`` numbers of length one: close tails have close ones.  Terms are
    counted for ``SKETCH_TAILS`` tails at once."""
    out = np.zeros((len(tails), DIMS), np.float32)
    for at in range(0, len(tails), SKETCH_TAILS):
        part = tails[at:at + SKETCH_TAILS]
        own = np.repeat(np.arange(len(part), dtype=np.uint32), [len(t) for t in part])
        pair = np.sort(own << 16 | np.concatenate(part))
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        tf = np.diff(np.append(first, len(pair))).astype(np.float32)
        term, tail = pair[first] & 0xFFFF, pair[first] >> 16
        weight = shared_idf[term] * (tf / (tf + K1))
        start = np.searchsorted(tail, np.arange(len(part) + 1))
        for k in range(len(part)):
            some = slice(start[k], start[k + 1])
            out[at + k] = weight[some] @ axes[term[some]]
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)


def centres_of(points: np.ndarray, most: int = CENTRES, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; each centre is followed by the nearest of those not listed yet."""
    k = max(1, min(most, len(points) // 4))
    c = points[np.random.default_rng(6).choice(len(points), k, replace=False)] if len(points) else np.zeros((1, DIMS), np.float32)
    for _ in range(rounds if len(points) else 0):
        own = (points @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, points)
        size = np.sqrt((sums ** 2).sum(axis=1, keepdims=True))
        c = np.where(size > 0, sums / np.maximum(size, 1e-9), c)
    like, order = c @ c.T, [0]
    free = np.ones(len(c), bool)
    free[0] = False
    while free.any():
        order.append(int(np.where(free, like[order[-1]], -np.inf).argmax()))
        free[order[-1]] = False
    return c[order].astype(np.float32)


def cells(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The three nearest centres as one number."""
    near = np.argsort(-(points @ centres.T), axis=1, kind="stable")[:, :3].astype(np.int64)
    out = np.zeros(len(points), np.int64)
    for k in range(3):
        out = out << 8 | (near[:, k] if k < near.shape[1] else 0)
    return out


def by_content(tails: DataFrame, shared_idf: np.ndarray, folder: str) -> DataFrame:
    """The tails with their cells, kept as a table."""
    spark = tails.sparkSession
    weights = spark.sparkContext.broadcast(shared_idf)

    @lean
    def sketches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        axes = projection()
        for p in parts:
            v = sketches_of([np.frombuffer(b, np.uint16) for b in p["ids"]], weights.value, axes)
            yield pd.DataFrame({"v": [x.tobytes() for x in v]})

    some = sample_of(tails.select("row", "ids"), F.col("row"), MAX_CENTRE_TAILS).select("ids").mapInPandas(sketches, "v binary")
    points = [np.frombuffer(bytes(r["v"]), np.float32) for r in some.collect()]
    points = sorted(points, key=lambda v: v.tobytes())
    centres = spark.sparkContext.broadcast(centres_of(np.array(points, np.float32).reshape(-1, DIMS)))

    @lean
    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        axes = projection()
        for p in parts:
            if len(p):
                v = sketches_of([np.frombuffer(b, np.uint16) for b in p["ids"]], weights.value, axes)
                yield p.assign(cell=cells(v, centres.value))

    schema = "row long, doc_id string, doc_tokens long, start long, ids binary, cell long"
    tails.mapInPandas(place, schema).write.option("compression", "zstd").parquet(f"{folder}/dealt")
    return spark.read.schema(schema).parquet(f"{folder}/dealt")


class Index:
    """BM25 inverted index of a shard's tails."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float):
        self.n = len(tails)
        lengths = [len(t) for t in tails]
        kind = np.uint32 if self.n <= 1 << 16 else np.int64     # half the bytes to sort, for any usual shard
        pair = np.sort((np.repeat(np.arange(self.n, dtype=kind), lengths) << 16) | np.concatenate(tails))
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        tf = np.diff(np.append(first, len(pair))).astype(np.float32)
        doc, term = (pair[first] >> 16).astype(np.int32), (pair[first] & 0xFFFF).astype(np.int64)
        size = np.bincount(doc, minlength=self.n)
        norm = K1 * (1 - B + B * np.array(lengths, np.float32) / max(mean, 1.0))
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[doc])
        at = np.concatenate([[0], np.cumsum(size)])
        self.query = [term[at[k]:at[k + 1]] for k in range(self.n)]
        # terms of at least a quarter of the tails are columns of a table, the others lists
        often = np.bincount(term, minlength=1 << 16) * 4 >= self.n
        self.column = np.where(often, np.cumsum(often) - 1, -1)
        dense = often[term]
        self.table = np.zeros((self.n, int(often.sum())), np.float32)
        self.table[doc[dense], self.column[term[dense]]] = weight[dense]
        doc, term, weight = doc[~dense], term[~dense], weight[~dense]
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.first = np.searchsorted(term[order], np.arange((1 << 16) + 1))

    def scores(self, k: int) -> np.ndarray:
        t = self.query[k]
        asked = np.zeros(self.table.shape[1], np.float32)
        asked[self.column[t][self.column[t] >= 0]] = 1
        start, runs = self.first[t], self.first[t + 1] - self.first[t]
        at = np.repeat(start - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(runs.sum())
        return self.table @ asked + np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def fill(lengths: np.ndarray, scores, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (tail, start in it, length).  ``scores(k)`` ranks neighbours of tail k."""
    unused = np.ones(len(lengths), bool)
    by_length = np.argsort(-lengths, kind="stable")
    at, rest = 0, None  # rest: (tail, start) that was cut
    while True:
        if rest is None:
            while at < len(by_length) and not unused[by_length[at]]:
                at += 1
            if at == len(by_length):
                return
            rest = (int(by_length[at]), 0)
            unused[rest[0]] = False
        seed, start = rest
        rest = None
        take = min(window, int(lengths[seed]) - start)
        out, room = [(seed, start, take)], window - take
        if room:
            left = np.flatnonzero(unused)
            if len(left):
                ranked = left[np.argsort(-scores(seed)[left], kind="stable")]
                ends = np.cumsum(lengths[ranked])
                whole = int(np.searchsorted(ends, room, side="right"))
                for k in ranked[:whole].tolist():
                    out.append((k, 0, int(lengths[k])))
                unused[ranked[:whole]] = False
                room -= int(ends[whole - 1]) if whole else 0
                if room and whole < len(ranked):
                    k = int(ranked[whole])
                    out.append((k, 0, room))
                    unused[k] = False
                    rest = (k, room)
        yield out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None,
         window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Per piece: id, doc_tokens, start, sequence_id, offset and ids (binary, little-endian 32 bits)."""
    spark = docs.sparkSession
    vocab = vocab or public_tokenizers.path("byte_bpe_50k.tiktoken")
    folder = scratch_dir(spark, "packing")
    tokens = tokenized(docs, folder, id_col, text_col, vocab, window)
    idf, shared_idf, mean = term_weights(tokens)
    tails = tokens.where(F.col("kind") == TAIL).select("row", "doc_id", "doc_tokens", "start", "ids")
    total = tails.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    shards = max(1, -(-total // (2 * shard_tokens)))
    weights = spark.sparkContext.broadcast(idf)  # 65,536 numbers
    names = ["doc_id", "doc_tokens", "start", "sequence_id", "offset", "ids"]

    def one_shard(rows: list[tuple], base: int) -> tuple[pd.DataFrame, int]:
        ids = [np.frombuffer(r[-1], np.uint16) for r in rows]
        index = Index(ids, weights.value, mean)
        out, k = [], 0
        for k, w in enumerate(fill(np.array([len(t) for t in ids]), index.scores, window), 1):
            offset = 0
            for tail, start, n in w:
                doc_id, doc_tokens, first, _ = rows[tail]
                out.append((doc_id, doc_tokens, first + start, 2 * (base + k) - 1, offset,
                            ids[tail][start:start + n].astype("<u4").tobytes()))
                offset += n
        return pd.DataFrame(out, columns=names), base + k

    @lean
    def shards_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A range of about one shard in order; one of long tails is cut into more."""
        base, held, size = TaskContext.get().partitionId() << 33, [], 0
        for p in parts:
            for r in p[["doc_id", "doc_tokens", "start", "ids"]].itertuples(index=False, name=None):
                if held and 2 * (size + len(r[-1])) > 6 * shard_tokens:
                    out, base = one_shard(held, base)
                    yield out
                    held, size = [], 0
                held.append(r)
                size += len(r[-1])
        if held:
            yield one_shard(held, base)[0]

    @lean
    def widen(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            p["ids"] = [np.frombuffer(b, np.uint16).astype("<u4").tobytes() for b in p["ids"]]
            yield p

    schema = "doc_id string, doc_tokens long, start long, sequence_id long, offset long, ids binary"
    own = ["doc_id", "doc_tokens", "start", "sequence_id"]
    alone = tokens.where(F.col("kind") == FULL).select(*own, F.lit(0).cast("long").alias("offset"), "ids").mapInPandas(widen, schema)
    dealt = by_content(tails, shared_idf, folder) if shards > 1 else tails.withColumn("cell", F.lit(0).cast("long"))
    order = ["cell", F.xxhash64("row"), "row"]
    packed = dealt.repartitionByRange(shards, *order).sortWithinPartitions(*order).mapInPandas(shards_of, schema)
    return alone.unionByName(packed).withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack(table(spark, sf_dir, "documents")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: the pieces of what is kept."""
    return digests(pack(docs))
