"""Spelling variants: words one inserted, deleted or replaced code point apart, grouped under their frequent form.

A word is marked with a terminator and all its rotations are sorted (a permuterm index).  The rotation that ends
with the edited character, without that character, is the word with a gap there:

* two words with the same gapped rotation differ by a *replaced* character;
* a gapped rotation that is a whole rotation of another word is that word with a character *inserted*.

So the sorted rotations are scanned in groups of equal prefix: a group has one whole word at most and one gapped word per
character of the alphabet, whatever the number of words.  Only rotations are moved, 2 x length + 1 of a
word; neighbours are emitted from the scan and no other pair is ever formed.  A character inserted in a run of
its like gives the same word at every place of the run; the place at the front of the run is taken, so each pair of near words
is emitted once in each direction.

A word's form is its most frequent near word if that is ``ratio`` times as frequent; following forms ends at the root.  Counts
rise along the way by the factor ``ratio``, so the chain has no loop and its length grows with the logarithm of
the largest count; it is followed by doubling.  Every round is a table in the shared folder.

Defined results: null texts and empty ones have no words; a null id stands for an empty one; texts of any length are
read whole; rows with equal ids are separate documents; other columns are ignored; null words are ignored and the counts of
repeated ones added; a word that holds the terminator U+0000 has no near words; empty tables: no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerflow.llm.common import lean, table
from layerflow.session import scratch_dir

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
EVERY = 199
FLUSH_WORDS = 300_000
END = "\0"
#: Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8, after the lower-casing of A-Z.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                every: int = EVERY) -> DataFrame:
    """(word, n), n summed per task: each document's runs, of which one in ``every`` lost a character by the hash of
    document and run."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def rows() -> pa.RecordBatch:
            words = [w for w in counts if len(w) >= min_length and len(w.decode()) >= min_length]
            n = [counts[w] for w in words]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                                              ["word", "n"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                own: dict[bytes, int] = {}
                for w in RUN.findall((text.as_py() or b"").lower()):  # of bytes: only A-Z
                    own[w] = own.get(w, 0) + 1
                for w, n in own.items():
                    h = zlib.crc32(w, start)
                    if h % every == 0:
                        s = w.decode()
                        at = h % len(s)
                        w = (s[:at] + s[at + 1:]).encode()
                    counts[w] = counts.get(w, 0) + n
                if len(counts) > FLUSH_WORDS:
                    yield rows()
        yield rows()

    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "word string, n long")


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, gap, indel, word, n): whole rotations have no gap; a gapped one has the character left out, and
    ``indel`` if that place stands for its insertion."""
    places = words.where(~F.contains("word", F.lit(END))).select("word", "n", F.explode(
        F.sequence(F.lit(0), F.length("word"))).alias("at"))
    word, at = F.col("word"), F.col("at")
    before, after = F.left(word, at), F.substring(word, at + F.lit(1), F.length(word))
    gap = F.substring(word, at + F.lit(1), F.lit(1))
    whole = F.struct(F.concat(after, F.lit(END), before).alias("prefix"), F.lit(None).cast("string").alias("gap"),
                     F.lit(False).alias("indel"))
    gapped = F.struct(F.concat(F.substring(word, at + F.lit(2), F.length(word)), F.lit(END), before).alias("prefix"),
                      gap.alias("gap"), (gap != F.right(before, F.lit(1))).alias("indel"))
    both = F.when(at < F.length(word), F.array(whole, gapped)).otherwise(F.array(whole))
    return places.select("word", "n", F.explode(both).alias("r")).select("r.*", "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of near words, once in each direction.  ``words`` has each word once."""
    group = Window.partitionBy("prefix")
    shared = rotations(words).withColumn("members", F.count("*").over(group)).where("members > 1")
    listed = shared.withColumn("others", F.collect_list(F.struct("gap", "indel", "word", "n")).over(group))
    gap, indel = F.col("gap"), F.col("indel")
    near = F.filter("others", lambda o: F.when(gap.isNull(), o["indel"]).when(o["gap"].isNull(), indel).otherwise(
        o["gap"] != gap))
    return listed.select("word", "n", F.explode(near).alias("o")).select(
        "word", "n", F.col("o.word").alias("near"), F.col("o.n").alias("near_n"))


def roots_of(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root) of (word, root), each root replaced by its own until none has one."""
    spark, k = forms.sparkSession, 0
    forms.write.parquet(f"{folder}/0")
    while True:
        now = spark.read.schema("word string, root string").parquet(f"{folder}/{k}")
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        if now.join(ahead, "root", "left_semi").isEmpty():
            return now
        k += 1
        now.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root")).write.parquet(f"{folder}/{k}")


def group_variants(counts: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                   ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of ``counts`` (word, n)."""
    if ratio < 2:
        raise ValueError("a form is at least twice as frequent: else forms can go round in a loop")
    spark, folder = counts.sparkSession, scratch_dir(counts.sparkSession, "spelling")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    words = written(counts.where(F.length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= min_count), "words")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    frequent = -F.col("best.less") >= ratio * F.col("n")
    formed = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n")), "formed")
    roots = roots_of(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), f"{folder}/roots")
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(word_counts(table(spark, sf_dir, "documents")))


OP12_SQL = """
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
runs AS (SELECT run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run FROM documents) GROUP BY doc_id, run),
hashed AS (SELECT run, n, xor(list_reduce(list_transform(range(strlen(s)),
    lambda k: ('0x' || substr(hex(encode(s)), (2 * k + 1)::INTEGER, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM runs, crc),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 199 <> 0 THEN run ELSE
        substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) END AS word FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, n, substr(word, 1, pos::INTEGER - 1) AS a, substr(word, pos::INTEGER + 1) AS b
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM words)),
near AS (SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM cuts x JOIN cuts y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
    UNION SELECT x.word, x.n, y.word, y.n FROM cuts x JOIN words y ON x.a || x.b = y.word
    UNION SELECT y.word, y.n, x.word, x.n FROM cuts x JOIN words y ON x.a || x.b = y.word),
best AS (SELECT word, n, count(*) AS n_near, max(near_n) AS best_n FROM near GROUP BY word, n),
forms AS (SELECT word, min(near) AS form, any_value(best_n) AS form_n FROM near JOIN best USING (word, n)
    WHERE near_n = best_n AND best_n >= 5 * n GROUP BY word),
chain AS (SELECT word, form AS root FROM forms
    UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON chain.root = forms.word),
roots AS (SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms))
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN best b USING (word) LEFT JOIN forms f USING (word) LEFT JOIN roots r USING (word)
"""
