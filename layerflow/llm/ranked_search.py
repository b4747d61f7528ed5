"""Ranked lexical search with presence masks: the ``k`` best documents of every item, exactly.

A document's score for an item is a sum over the item's terms, each term's share growing with its frequency
in the document.  Documents are taken in blocks; a block holds one bitmap of documents per term.  For an item

1. the terms are put in order of the most they can add in this block; bitmaps of the terms without which the ``k``-th
   best score so far cannot be reached are OR-ed, the other documents are out;
2. the bitmaps of all its terms give each remaining document its mask of matched terms, and documents are grouped by
   mask;
3. the distinct masks are evaluated by descending maximum score, until the next one's maximum is below the
   ``k``-th best score: no document left can be among the best, not by a tie either.

A task keeps the ``k`` best of each item over all its blocks, so it sends ``k`` rows an item, merged in two levels.
Document frequencies, N and L are counted over all documents before (partial counts per task).  The items are
the stated query set: they go to the tasks in blocks of about ``BLOCK_TERMS`` terms, one block at a time, so neither
driver nor task holds more than that, and each block is one pass over the documents.

Defined results: a null or empty text, or one without a term, is no document (not counted, never returned); an item
without terms, or whose terms no document has, has no rows; rows with equal ids are separate documents; a null doc_id is
ranked after the others of its score; rows of equal item id and text are one item, equal ids with different
texts are ranked each for itself; texts of any length are read whole; other columns are ignored; empty tables: no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerflow.llm.common import lean, table
from layerflow.session import scratch_dir

TOP = 20
BLOCK_TERMS = 200_000
BLOCK_DOCS, BLOCK_TOKENS = 16_384, 4_000_000
FLUSH_TERMS = 300_000
EVALUATE = 64
MERGE_WAYS = 256
#: Term characters: everything but ASCII that is no letter or digit; only A-Z are lower-cased.  Of UTF-8 bytes.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                   for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(TERM_BYTES).split() if text else []


def _texts(column: pa.Array) -> Iterator[bytes | None]:
    return (t.as_py() for t in column.cast(pa.binary()))


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(term, df, tokens): documents and occurrences of each term; the null term has N and L."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        tokens: Counter = Counter()

        def rows() -> pa.RecordBatch:
            columns = [pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64()),
                       pa.array([tokens.get(t, 0) for t in df], pa.int64())]
            df.clear()
            return pa.RecordBatch.from_arrays(columns, ["term", "df", "tokens"])

        for b in batches:
            for t in _texts(b.column(0)):
                if terms := terms_of(t):
                    df.update(set(terms))
                    df[None] += 1
                    tokens[None] += len(terms)
                if len(df) > FLUSH_TERMS:
                    yield rows()
                    tokens.clear()
        yield rows()

    counts = texts.mapInArrow(run, "term binary, df long, tokens long")
    return counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tokens").alias("tokens"))


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term, times) of (item, text)."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, t, n) for i, x in zip(b.column(0).to_pylist(), _texts(b.column(1)))
                    for t, n in Counter(terms_of(x)).items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(
                zip(*rows) if rows else ([],) * 3, (pa.int64(), pa.binary(), pa.int64()))], ["item", "term", "times"])

    return items.select("item", "text").mapInArrow(run, "item long, term binary, times long")


class Block:
    """Documents of a task: bitmaps and shares by term.  ``ids`` are the term numbers of all documents in a row,
    ``counts`` how many are each document's."""

    def __init__(self, ids: list[int], counts: list[int], tokens: list[int], n_docs: int, n_tokens: int):
        self.size = len(counts)
        width = -(-self.size // 8) * 8
        key, tf = np.unique(np.array(ids, np.int64) * width + np.repeat(np.arange(self.size), counts), return_counts=True)
        term, self.doc = np.divmod(key, width)
        damping = 75 + (25 * np.array(tokens, np.int64) * n_docs) // max(n_tokens, 1)
        self.share = (1_000_000_000 * tf) // (1000 * tf + 12 * damping[self.doc])
        terms, start = np.unique(term, return_index=True)
        self.bounds = np.append(start, len(key))
        self.number = {t: k for k, t in enumerate(terms.tolist())}
        self.most = np.maximum.reduceat(self.share, start) if len(key) else np.zeros(0, np.int64)
        self.bitmaps = np.zeros((len(terms), width // 8), np.uint8)
        for at in range(0, len(terms), 512):
            some = slice(self.bounds[at], self.bounds[min(at + 512, len(terms))])
            present = np.zeros((min(512, len(terms) - at), width), bool)
            present[np.searchsorted(terms, term[some]) - at, self.doc[some]] = True
            self.bitmaps[at:at + 512] = np.packbits(present, axis=1)

    def best(self, terms: list[int], weights: list[int], kept: "Best", doc_ids: list) -> None:
        """Adds to ``kept`` the documents that can be among the best."""
        own = [(self.number[t], w) for t, w in zip(terms, weights) if t in self.number]
        if not own:
            return
        rows, weight = map(np.array, zip(*own))
        upper = weight * self.most[rows]
        order = np.argsort(-upper, kind="stable")
        rows, weight, upper = rows[order], weight[order], upper[order]
        rest = np.cumsum(upper[::-1])[::-1]
        needed = int(np.count_nonzero(rest >= kept.least))
        if not needed:
            return
        bitmaps = self.bitmaps[rows]
        docs = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bitmaps[:needed], axis=0)))
        if not len(docs):
            return
        bits = np.unpackbits(bitmaps, axis=1)[:, docs]
        group, first = grouped(np.packbits(bits, axis=0))
        most = upper @ bits[:, first].astype(np.int64)
        by_mask = np.argsort(most, kind="stable")[::-1]
        place = np.empty_like(by_mask)
        place[by_mask] = np.arange(len(by_mask))
        turn = place[group]
        turns = np.argsort(turn, kind="stable")  # documents, masks of the highest maximum first
        most = most[by_mask][turn[turns]]
        at = 0
        while at < len(turns) and most[at] >= kept.least:
            some = turns[at:at + EVALUATE]
            score = np.zeros(len(some), np.int64)
            for j, (r, w) in enumerate(zip(rows.tolist(), weight.tolist())):
                has = np.flatnonzero(bits[j, some])
                lo, hi = self.bounds[r], self.bounds[r + 1]
                score[has] += w * self.share[lo + np.searchsorted(self.doc[lo:hi], docs[some[has]])]
            good = np.flatnonzero(score >= kept.least)
            kept.add(score[good].tolist(), [doc_ids[d] for d in docs[some[good]].tolist()])
            at += EVALUATE


def grouped(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group of each column, first column of each group) of a matrix of mask bytes with any number of rows."""
    padded = np.zeros((masks.shape[1], -(-len(masks) // 8) * 8), np.uint8)
    padded[:, :len(masks)] = masks.T
    words = padded.view(np.uint64)
    _, first, group = np.unique(words[:, 0], return_index=True, return_inverse=True)
    for k in range(1, words.shape[1]):
        value, word = np.unique(words[:, k], return_inverse=True)
        _, first, group = np.unique(group * len(value) + word, return_index=True, return_inverse=True)
    return group, first


class Best:
    """The ``top`` best (score, doc_id) so far: scores descending, ids ascending, null ids last."""

    def __init__(self, top: int):
        self.top, self.rows, self.least = top, [], 1

    def add(self, scores: list[int], doc_ids: list) -> None:
        self.rows += [(-s, d is None, d) for s, d in zip(scores, doc_ids)]
        self.rows.sort(key=lambda r: r if r[2] is not None else (*r[:2], 0))
        del self.rows[self.top:]
        if len(self.rows) == self.top:
            self.least = -self.rows[-1][0]


def best_of_block(docs: DataFrame, queries: dict[int, list[tuple[bytes, int]]], n_docs: int, n_tokens: int,
                  top: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents for the given items."""
    shared = docs.sparkSession.sparkContext.broadcast(queries)
    kind = docs.schema["doc_id"].dataType

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        asked = [(i, [number.setdefault(t, len(number) + 1) for t, _ in own], [w for _, w in own])
                 for i, own in shared.value.items()]
        kept = {i: Best(top) for i, _, _ in asked}
        ids, counts, tokens, doc_ids, id_type = [], [], [], [], pa.null()

        def evaluate() -> None:
            if ids:
                block = Block(ids, counts, tokens, n_docs, n_tokens)
                for i, terms, weights in asked:
                    block.best(terms, weights, kept[i], doc_ids)
            for x in (ids, counts, tokens, doc_ids):
                x.clear()

        for b in batches:
            id_type = b.column(0).type
            for d, t in zip(b.column(0).to_pylist(), _texts(b.column(1))):
                terms = terms_of(t)
                own = list(filter(None, map(number.get, terms)))
                if own:
                    ids += own
                    counts.append(len(own))
                    tokens.append(len(terms))
                    doc_ids.append(d)
                if len(counts) >= BLOCK_DOCS or len(ids) >= BLOCK_TOKENS:
                    evaluate()
        evaluate()
        out = [(i, r[2], -r[0]) for i, k in kept.items() for r in k.rows]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out), (pa.int64(), id_type, pa.int64()))], ["item", "doc_id", "score"])

    return docs.mapInArrow(run, f"item long, doc_id {kind.simpleString()}, score long")


def merged(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` best of each item with their ranks, through at most ``MERGE_WAYS`` parts an item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parts = found.withColumn("way", F.spark_partition_id() % MERGE_WAYS)
    near = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item", "way").orderBy(*order)))
    near = near.where(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` highest-scoring documents of every item."""
    spark, folder = docs.sparkSession, scratch_dir(docs.sparkSession, "ranked_search")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    asked = written(items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).distinct().select(
        F.monotonically_increasing_id().alias("item"), "item_id", "text"), "items")
    terms = written(item_terms(asked), "terms")
    counts = written(corpus_counts(rows.select("text")), "counts")
    total = counts.where("term IS NULL").first()
    n_docs, n_tokens = (total["df"], total["tokens"]) if total else (0, 0)
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    weighted = written(terms.join(counts.where("term IS NOT NULL"), "term").select(
        "item", "term", (F.col("times") * weight).alias("weight")).where("weight > 0"), "weighted")
    blocks = max(1, -(-weighted.count() // block_terms))
    for k in range(blocks):
        queries: dict[int, list[tuple[bytes, int]]] = {}
        for r in weighted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).toLocalIterator():
            queries.setdefault(r["item"], []).append((bytes(r["term"]), r["weight"]))
        merged(best_of_block(rows, queries, n_docs, n_tokens, top), top).write.parquet(f"{folder}/found/block={k}")
    kind = docs.schema[id_col].dataType.simpleString()
    found = spark.read.schema(f"item long, rank int, doc_id {kind}, score long, block int").parquet(f"{folder}/found")
    return found.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
total AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM docs WHERE len(t) > 0),
tf AS (SELECT r, doc_id, len_t, term, count(*) AS tf
       FROM (SELECT r, doc_id, len(t) AS len_t, unnest(t) AS term FROM docs) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (SELECT item_id, term, count(*) AS times
          FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
weighted AS (SELECT item_id, term, times * floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
             FROM asked JOIN df USING (term), total),
scored AS (SELECT item_id, r, doc_id,
                  sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len_t * n) // l))))::BIGINT AS score
           FROM weighted JOIN tf USING (term), total GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
                  doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
