"""Benchmark decontamination: SimHash of item-sized windows, a multi-index over Hamming blocks, and
exact weighted-shingle similarity of what it finds.

A benchmark item of w words is compared with every window of w words of every document.  A window's
fingerprint is the 64-bit SimHash of its word shingles, weighted by how often each occurs.  The
fingerprints of the items are indexed by ``RADIUS`` + 1 blocks of bits: two fingerprints that differ
in at most ``RADIUS`` bits agree in one block at least, so looking up a window's blocks finds *all*
items of its size within the radius.  They are verified by the weighted Jaccard similarity of the
shingles themselves, at least ``SIMILARITY``.

A window with less than 2s/(1+s) of its shingle weight in the items of its size cannot reach similarity s
with any of them (equal sizes: overlap / (2w - overlap) >= s), so fingerprints are made for the other
windows only; no pair is lost by that.  The benchmark is sent to the executors in blocks of at most
``BLOCK_WORDS`` words, each compared with all documents, so what is broadcast does not grow with it.

Words are runs of letters and digits, lower-cased.  Defined results: null and empty texts have no
words and match nothing; an item with fewer words than a shingle is one shingle; equal items each
match; rows with equal ids count as one document (the best match of an item is kept); other columns are ignored;
an empty table on either side gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import lean, table
from layerflow.llm.rowfilter import split
from layerflow.session import scratch_dir

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCK_WORDS = 1_000_000
#: windows that are fingerprinted at once
STEP = 4_096
WORD = re.compile(r"[^\W_]+")
BITS = np.arange(64, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 (SimHash looks at single bits)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(words: np.ndarray, size: int = SHINGLE, starts: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each shingle, or of those that begin at ``starts``, from the words' hashes."""
    n = max(len(words) - size + 1, 0) if starts is None else len(starts)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = (h ^ (words[k:n + k] if starts is None else words[starts + k])) * MIX + np.uint64(k + 1)
        h ^= h >> np.uint64(29)
    return mixed(h)


def blocks(prints: np.ndarray, radius: int) -> Iterator[np.ndarray]:
    """The values of each of radius + 1 blocks of the 64 bits."""
    edges = np.linspace(0, 64, radius + 2).astype(int)
    for a, b in zip(edges[:-1], edges[1:]):
        yield (prints >> np.uint64(a)) & np.uint64((1 << int(b - a)) - 1)


def window_prints(h: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash of the windows h[s:s + width]; a shingle counts as often as it occurs."""
    out = np.zeros(len(starts), np.uint64)
    for at in range(0, len(starts), STEP):
        s = starts[at:at + STEP]
        lo = int(s[0])
        # neighbouring starts share one running sum; a jump begins a new one
        cuts = np.flatnonzero(np.diff(s) > width) + 1
        for part in np.split(s, cuts):
            lo, hi = int(part[0]), int(part[-1]) + width
            signs = ((h[lo:hi, None] >> BITS) & np.uint64(1)).astype(np.int32) * 2 - 1
            run = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs, axis=0, dtype=np.int32)])
            sums = run[part - lo + width] - run[part - lo]
            i = at + int(np.searchsorted(s, part[0]))
            out[i:i + len(part)] = ((sums > 0).astype(np.uint64) << BITS).sum(axis=1, dtype=np.uint64)
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two lists of shingles, weight = occurrences."""
    (u, n), (v, m) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both / (len(a) + len(b) - both) if both else 0.0


class Benchmark:
    """One block of items, indexed by window width in shingles and Hamming block."""

    def __init__(self, items: list[tuple[str, str]], similar: float, radius: int):
        self.similar, self.radius = similar, radius
        self.vocab: dict[str, int] = {}
        self.by_words: dict[int, list[tuple[str, np.ndarray]]] = {}
        for item, text in items:
            words = WORD.findall((text or "").lower())
            if not words:
                continue
            size = min(SHINGLE, len(words))
            h = shingles(np.array([self._hash(w) for w in words], np.uint64), size)
            self.by_words.setdefault(len(words), []).append((item, h))
        self.hashes = {size: self._held(size) for size in sorted({min(SHINGLE, n) for n in self.by_words})}
        self.index = {n: self._indexed(own) for n, own in self.by_words.items()}

    def _hash(self, word: str) -> int:
        if word not in self.vocab:
            self.vocab[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) | 1
        return self.vocab[word]

    def _held(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sorted shingles of all items; the lengths in words of the items that hold shingle k are
        ``lengths[first[k]:first[k + 1]]``."""
        held = {n: np.unique(np.concatenate([h for _, h in own]))
                for n, own in self.by_words.items() if min(SHINGLE, n) == size}
        h, lengths = np.concatenate(list(held.values())), np.repeat(list(held), [len(v) for v in held.values()])
        order = np.argsort(h, kind="stable")
        known, first = np.unique(h[order], return_index=True)
        return known, np.append(first, len(h)), lengths[order]

    def _indexed(self, own):
        prints = np.concatenate([window_prints(h, np.array([0]), len(h)) for _, h in own])
        tables = []
        for values in blocks(prints, self.radius):
            t: dict[int, list[int]] = {}
            for k, v in enumerate(values.tolist()):
                t.setdefault(v, []).append(k)
            tables.append({v: np.array(k) for v, k in t.items()})
        return prints, tables

    def matches(self, text: str | None) -> Iterator[tuple[str, int, int, float]]:
        """(item, first word, words, similarity): the best window of each item that the text holds."""
        words = WORD.findall((text or "").lower())
        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.uint64, len(words))
        strange = np.concatenate([[0], np.cumsum(ids == 0)])  # words that no item has
        for size, (known, first, lengths) in self.hashes.items():
            if len(ids) < size:
                continue
            # only shingles without a strange word can be an item's
            maybe = np.flatnonzero(strange[size:] == strange[:-size])
            if not len(maybe):
                continue
            some = shingles(ids, size, maybe)
            at = np.minimum(np.searchsorted(known, some), len(known) - 1)
            same = known[at] == some
            if not same.any():
                continue
            h, places = shingles(ids, size), maybe[same]
            kinds, kind = np.unique(at[same], return_inverse=True)
            # each distinct shingle with every length of the items that hold it
            times = first[kinds + 1] - first[kinds]
            who = np.repeat(np.arange(len(kinds)), times)
            of = lengths[np.arange(len(who)) + np.repeat(first[kinds] - np.cumsum(times) + times, times)]
            for n in np.unique(of).tolist():
                if len(words) >= n:
                    held = np.zeros(len(kinds), bool)
                    held[who[of == n]] = True
                    yield from self._of_width(n, self.by_words[n], h, places[held[kind]])

    def _of_width(self, n, own, h, places):
        width = len(own[0][1])
        need = 2 * self.similar / (1 + self.similar) * width
        if len(places) < need - 1e-9:
            return
        hits = np.zeros(len(h) + 1, np.int64)
        hits[places + 1] = 1
        hits = np.cumsum(hits)
        starts = np.flatnonzero(hits[width:] - hits[:-width] >= need - 1e-9)
        if not len(starts):
            return
        prints = window_prints(h, starts, width)
        found, tables = self.index[n]
        best: dict[int, tuple[float, int]] = {}
        values = list(blocks(prints, self.radius))
        for i, s in enumerate(starts.tolist()):
            near = [t[v] for t, b in zip(tables, values) if (v := int(b[i])) in t]
            if not near:
                continue
            near = np.unique(np.concatenate(near))
            near = near[np.bitwise_count(found[near] ^ prints[i]) <= self.radius]
            for k in near.tolist():
                if best.get(k, (0.0, 0))[0] < 1.0:
                    x = similarity(h[s:s + width], own[k][1])
                    if x >= self.similar and x > best.get(k, (0.0, 0))[0]:
                        best[k] = (x, s)
        for k, (x, s) in best.items():
            yield own[k][0], s, n, x


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of at most ``block_words`` words (a longer item is a block of its own)."""
    own, words = [], 0
    rows = items.select(F.col(id_col).cast("string").alias("i"), F.coalesce(text_col, F.lit("")).alias("t"))
    for r in rows.where("t <> ''").toLocalIterator():
        n = r["t"].count(" ") + 1
        if own and words + n > block_words:
            yield own
            own, words = [], 0
        own.append((r["i"], r["t"]))
        words += n
    if own:
        yield own


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", similar: float = SIMILARITY,
               radius: int = RADIUS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and item that it holds: start and length in words, similarity."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id string, item_id string, start_word long, n_words long, similarity double"

    def scan(block: list[tuple[str, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        @lean
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            bench = Benchmark(shared.value, similar, radius)
            for p in parts:
                yield pd.DataFrame([(d, *m) for d, t in zip(p["doc_id"], p["text"]) for m in bench.matches(t)],
                                   columns=["doc_id", "item_id", "start_word", "n_words", "similarity"])

        return rows.mapInPandas(run, schema)

    found = [scan(b) for b in item_blocks(items, item_col, item_text, block_words)]
    out = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)
    # rows with equal ids: the best match of an item; ties: the first place
    out = out.groupBy("doc_id", "item_id").agg(F.max_by(
        F.struct("start_word", "n_words", "similarity"), F.struct("similarity", -F.col("start_word"))).alias("m"))
    return out.select(F.col("doc_id").cast(docs.schema[id_col].dataType), F.col("item_id").cast(items.schema[item_col].dataType), "m.*")


def op1_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("similarity", F.round("similarity", 6))


def decontam_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark passage.  Rows are told apart by id and text: a leaking row takes
    no other text with it, whatever ids are null or repeated; rows with equal id and text share the decision.  What
    goes is written first; texts that stay are not moved (see :mod:`.rowfilter`)."""
    path = f"{scratch_dir(spark, 'decontam')}/leaks"
    # a null id leaves the hash of the text alone, an id follows it
    own = F.concat_ws(":", F.xxhash64(docs["text"]).cast("string"), docs["doc_id"].cast("string"))
    rows = docs.select(own.alias("doc_id"), "text")
    find_leaks(rows, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leak")).distinct().write.parquet(path)
    leaks = spark.read.schema("leak string").parquet(path)
    hit, untouched = split(docs, leaks, F.xxhash64("leak"), F.xxhash64(own))
    own_hit = F.concat_ws(":", F.xxhash64(hit["text"]).cast("string"), hit["doc_id"].cast("string"))
    return untouched.unionByName(hit.join(leaks, own_hit == leaks["leak"], "left_anti"))
