"""Language identification with string kernels.

The kernel of two texts is their number of common character n-grams (n = 1..3, presence, blended
over n) by the geometric mean of their own numbers.  Nyström: ``LANDMARKS`` landmark texts span the
feature space, K_xm K_mm^(-1/2); one ridge regression per language (targets +1 and -1) is solved in
it.  Because the kernel is a product of presence vectors, a batch of texts is scored by one matrix
product over the landmarks' n-grams: (presence x landmarks x weights) / norm, which is the same number.

Landmarks and training texts are a sample by hash of at most ``MAX_TRAIN`` labelled documents; the
texts stay on the executors, which return sums of bounded size.  Every whole text is scored.

Defined results: null text or no letter: ``und`` and 0; nothing to learn from (empty table, no
labels): ``und`` for all; one language only: that language; equal rows give equal results; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import lean, sample_of, table
from layerflow.session import scratch_dir

MAX_TRAIN = 4_000
LANDMARKS = 160
RIDGE = 1e-2
SHARPNESS = 6.0
#: texts of a scoring block hold at most so many code points, unless it is a single text
BLOCK_CHARS = 1_000_000
LETTER = regex.compile(r"\p{L}")
UND = "und"


def grams(text: str) -> np.ndarray:
    """Distinct n-grams of a text, n = 1..3, as sorted integers: 21 bits a code point, plus one so
    that lengths differ.  Case and white space are normalised first."""
    c = np.frombuffer(" ".join(text.lower().split()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if not len(c):
        return np.zeros(0, np.uint64)
    two = (c[:-1] << np.uint64(21)) | c[1:]
    three = (two[:-1] << np.uint64(21)) | c[2:] if len(c) > 2 else np.zeros(0, np.uint64)
    return np.unique(np.concatenate([np.unique(c), np.unique(two), three]))


class Model:
    """Weights by n-gram and language: column sums of the landmarks' presence, whitened."""

    def __init__(self, langs: list[str], vocab: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.langs, self.vocab, self.weights, self.bias = langs, vocab, weights, bias

    def scores(self, texts: list[str]) -> np.ndarray:
        """(texts, languages) regression values: one product of the sparse presence rows by weights."""
        sets = [grams(t) for t in texts]
        norm = np.sqrt(np.maximum([len(s) for s in sets], 1))
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        at = np.minimum(np.searchsorted(self.vocab, every), len(self.vocab) - 1)
        hit = self.vocab[at] == every
        out = np.zeros((len(sets), len(self.langs)))
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(row[hit], weights=self.weights[at[hit], k], minlength=len(sets))
        return out / norm[:, None] + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        named, sure = [UND] * len(texts), np.zeros(len(texts))
        todo = [i for i, t in enumerate(texts) if t is not None and LETTER.search(t)]
        at = 0
        while self.langs and at < len(todo):
            end, chars = at, 0
            while end < len(todo) and (end == at or chars + len(texts[todo[end]]) <= BLOCK_CHARS):
                chars += len(texts[todo[end]])
                end += 1
            part = todo[at:end]
            s = self.scores([texts[i] for i in part])
            p = np.exp(SHARPNESS * (s - s.max(axis=1, keepdims=True)))
            best = s.argmax(axis=1)  # ties: the first language in order
            sure[part] = p.max(axis=1) / p.sum(axis=1)
            for i, b in zip(part, best):
                named[i] = self.langs[b]
            at = end
        return named, sure


NOTHING = Model([], np.zeros(1, np.uint64), np.zeros((1, 0)), np.zeros(0))


def fit(labelled: DataFrame) -> Model:
    """``labelled`` has key, text and lang; rows with a null text or language are left out."""
    spark, folder = labelled.sparkSession, scratch_dir(labelled.sparkSession, "langid")
    some = sample_of(labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("key", "text", "lang"),
                     F.col("key"), MAX_TRAIN)
    some.write.parquet(f"{folder}/sample")      # the corpus is not scanned again for each step of the fit
    rows = spark.read.schema(some.schema).parquet(f"{folder}/sample")
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not langs:
        return NOTHING
    # landmarks: per language the text with the least hash in each of some hash buckets
    per = max(1, LANDMARKS // len(langs))
    h = F.xxhash64("key", F.lit(5))
    picked = rows.groupBy("lang", F.pmod(h, F.lit(per)).alias("b")).agg(F.min_by("text", F.struct(h, "text")).alias("text"))

    @lean
    def to_grams(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield pd.DataFrame({"lang": p["lang"], "b": p["b"], "g": [grams(t).tobytes() for t in p["text"]]})

    marks = picked.mapInPandas(to_grams, "lang string, b long, g binary").orderBy("lang", "b").collect()
    sets = [s for s in (np.frombuffer(bytes(r["g"]), np.uint64) for r in marks) if len(s)]
    if not sets:
        return NOTHING
    vocab = np.unique(np.concatenate(sets))
    z = np.zeros((len(vocab), len(sets)), np.float32)
    for j, s in enumerate(sets):
        z[np.searchsorted(vocab, s), j] = 1 / np.sqrt(len(s))
    kmm = (z.T @ z).astype(np.float64)
    values, vectors = np.linalg.eigh(kmm)
    keep = values > 1e-6 * values.max()
    project = z @ (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)  # n-grams x features
    m, index = int(keep.sum()), {name: k for k, name in enumerate(langs)}

    shared = labelled.sparkSession.sparkContext.broadcast((vocab, project))  # bounded by the landmarks' n-grams

    @lean
    def sums(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, w = shared.value
        gram, target, n = np.zeros((m + 1, m + 1)), np.zeros((m + 1, len(langs))), 0
        for p in parts:
            f = np.ones((len(p), m + 1))
            y = -np.ones((len(p), len(langs)))
            for i, (t, name) in enumerate(zip(p["text"], p["lang"])):
                s = grams(t)
                at = np.minimum(np.searchsorted(words, s), len(words) - 1)
                f[i, :m] = w[at[words[at] == s]].sum(axis=0) / np.sqrt(max(len(s), 1))
                y[i, index[name]] = 1
            gram, target, n = gram + f.T @ f, target + f.T @ y, n + len(p)
        yield pd.DataFrame({"n": [n], "gram": [gram.tobytes()], "target": [target.tobytes()]})

    parts = rows.coalesce(8).mapInPandas(sums, "n long, gram binary, target binary").collect()
    shared.unpersist()
    n = sum(r["n"] for r in parts)
    gram = sum(np.frombuffer(bytes(r["gram"])).reshape(m + 1, m + 1) for r in parts)
    target = sum(np.frombuffer(bytes(r["target"])).reshape(m + 1, len(langs)) for r in parts)
    w = np.linalg.solve(gram / n + RIDGE * np.eye(m + 1) * np.trace(gram / n) / (m + 1), target / n)
    return Model(langs, vocab, project.astype(np.float64) @ w[:m], w[m])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score."""
    spark = docs.sparkSession
    own_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast((model.langs, model.vocab, model.weights, model.bias))

    @lean
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(*shared.value)
        for p in parts:
            named, sure = own.predict([None if t is None or t is pd.NA else t for t in p["text"].astype(object)])
            yield pd.DataFrame({"doc_id": p["doc_id"], "lang_pred": named, "score": sure})

    out = rows.mapInPandas(run, "doc_id string, lang_pred string, score double")
    return out.withColumn("doc_id", F.col("doc_id").cast(own_type))


def held_out(doc_id: str) -> Column:
    """The contract's fold: crc32 of the id as text, remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out("doc_id")).select(F.col("doc_id").alias("key"), "text", "lang"))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
