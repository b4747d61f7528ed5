"""Token counts with a digest cache: only content that no earlier run has counted is encoded.

A text's *content* is its text with runs of ASCII blanks made one and none at its ends: the tokenizer drops white
space, so equal contents have equal counts.  The cache is an append-only Parquet folder with one part per tokenizer
version (a digest of the vocabulary file, the library's version and the rules of this module), its rows are
SHA-256 digests of contents and their counts.  A run

1. writes id, bytes and digest of every row: texts are not moved for that;
2. aggregates the digests (per task first: a text that a third of all rows repeat is one row a task) and keeps those
   that the cache lacks;
3. takes one text of each of these, made one per task before the shuffle, encodes it and appends the counts;
4. joins the digests of all rows with the counts.  Both sides are written tables, so AQE splits a hot digest.

With a filled cache the digests to encode are few; Spark then broadcasts them by their written size and texts with
known counts stay where they are.

A pre-token never spans white space, nor does a special string, and no character of a text is changed by one beyond
a blank.  So a text's count is the sum over its pieces between blanks, and every distinct piece goes through
the library once a task (beyond ``MEMO`` pieces the task forgets them and starts anew).

Defined results: a null text counts as empty (0 bytes, 0 tokens); texts of any length are counted whole; rows with
equal ids or texts each have a row, a null id stays null; other columns, whatever their names, are ignored; no rows: no
rows.  A cache row that two runs wrote at the same time counts once.  An append that was lost midway leaves rows that
are right; the next run encodes what is missing.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from collections import Counter

import public_tokenizers
import pyarrow as pa
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import lean, table
from layerflow.session import scratch_dir

VOCAB = "word_bpe_49k.json"
LIMIT = 2048
MEMO = 300_000
RULES = "ascii blanks collapsed, special strings recognised, none added; 1"
CACHE_SCHEMA = "content binary, n_tokens long"
ENCODE_BYTES = 1 << 20


def version_digest(vocab: str) -> str:
    """Digest of everything that a count depends on besides the text."""
    with open(vocab, "rb") as f:
        return hashlib.sha256(b"\0".join([f.read(), tokenizers.__version__.encode(), RULES.encode()])).hexdigest()


def content_digest(text: Column) -> Column:
    blank = "[ \\t\\n\\x0B\\f\\r]+"
    return F.unhex(F.sha2(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), blank, " ")), 256))


class Counted:
    """Counts of texts by the library, each distinct piece between ASCII blanks encoded once."""

    def __init__(self, vocab: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = tokenizers.Tokenizer.from_file(vocab)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[bytes, int] = {}

    def _learn(self, pieces: list[bytes]) -> None:
        at = 0
        while at < len(pieces):
            end, size = at, 0
            while end < len(pieces) and (end == at or size + len(pieces[end]) <= ENCODE_BYTES):
                size, end = size + len(pieces[end]), end + 1
            texts = [p.decode("utf-8", "replace") for p in pieces[at:end]]
            for p, e in zip(pieces[at:end], self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                self.memo[p] = len(e)
            at = end

    def count(self, text: bytes) -> int:
        pieces = Counter(text.split())  # of bytes: exactly the six ASCII blanks
        if len(self.memo) > MEMO:
            self.memo.clear()
        if new := [p for p in pieces if p not in self.memo]:
            self._learn(new)
        memo = self.memo
        return sum(memo[p] * n for p, n in pieces.items())


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The cache's rows of a tokenizer version, each content once; none if nothing was stored yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{cache}/tokenizer={version}")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA)
    rows = spark.read.schema(CACHE_SCHEMA).parquet(folder.toString())
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def encoded(texts: DataFrame, vocab: str, version: str) -> DataFrame:
    """(content, text) -> (content, n_tokens)."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if version_digest(vocab) != version:
            raise RuntimeError(f"{vocab} or the tokenizers library differs between driver and executor")
        counted = Counted(vocab)
        for b in batches:
            n = [counted.count(t.as_py()) for t in b.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["content", "n_tokens"])

    return texts.select("content", "text").mapInArrow(run, CACHE_SCHEMA)


def token_counts(docs: DataFrame, cache: str, vocab: str | None = None, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit.  ``cache`` is a folder in shared storage that runs share."""
    spark, vocab = docs.sparkSession, vocab or public_tokenizers.path(VOCAB)
    version, folder = version_digest(vocab), scratch_dir(spark, "token_counts")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn(
        "content", content_digest(F.col("text")))

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    digests = written(rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content"), "digests")
    keys = digests.select("content").distinct()
    misses = written(keys.join(stored_counts(spark, cache, version), "content", "left_anti"), "misses")
    texts = rows.groupBy("content").agg(F.min("text").alias("text")).join(misses, "content", "left_semi")
    encoded(texts, vocab, version).write.mode("append").parquet(f"{cache}/tokenizer={version}")
    known = written(stored_counts(spark, cache, version).join(keys, "content", "left_semi"), "known")
    return digests.join(known, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts with an empty cache of its own: its result and its work do not depend on earlier runs."""
    return token_counts(table(spark, sf_dir, "documents"), f"{scratch_dir(spark, 'token_cache')}/counts")
