"""Quality rules [native]: a ledger with one failure bit per rule.

Every rule is evaluated once per document and stored as a bit next to the measurements it came
from.  Policies are versioned sets of rules, applied later as one bit mask; ablations (what would
pass without rule r) are bitwise aggregations over the ledger, without another look at the texts.

Defined results: a null or empty text measures 0 everywhere; a text of blanks has no words; rows
with the same id are measured one by one; other columns are ignored; an empty table gives no rows.
Windows are compared by a 64-bit hash of their three words.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import BLANKS, WORD, let, table, without

SYMBOLS = "#*$%&|<>"
WINDOW = 3


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words in windows of ``window`` words that the text holds twice or more."""
    n = F.size(words)

    def windows(w: Column) -> Column:
        parts = F.arrays_zip(*[F.slice(w, k + 1, F.greatest(F.size(w) - window + 1, F.lit(0))).alias(f"w{k}")
                               for k in range(window)])
        return F.transform(parts, lambda p, i: F.struct(
            F.xxhash64(*[p[f"w{k}"] for k in range(window)]).alias("h"), i.alias("i")))

    def neighbours(s: Column) -> Column:  # sorted by hash: equal windows stand side by side
        pairs = F.arrays_zip(s.alias("a"), F.slice(s, 2, F.size(s)).alias("b"))
        same = F.filter(pairs, lambda p: p["a"]["h"] == p["b"]["h"])
        return F.array_distinct(F.flatten(F.transform(same, lambda p: F.array(p["a"]["i"], p["b"]["i"]))))

    at = let(F.sort_array(windows(words)), neighbours)
    covered = F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(*[i + k for k in range(window)]))))
    return F.when(n < window + 1, F.lit(0)).otherwise(F.size(covered))


def measurements(text: Column) -> Column:
    """struct of all measurements; the words and the lines are each split once."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("again"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("own"))

    words = let(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), of_words)
    lines = let(F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)), of_lines)
    return let(F.struct(words.alias("w"), lines.alias("l")), lambda x: F.struct(
        x["w"]["n"].alias("n_words"), F.length(without(t, BLANKS)).cast("long").alias("word_chars"),
        (n - F.length(without(t, SYMBOLS))).cast("long").alias("n_symbols"),
        (x["l"]["n"] - x["l"]["own"]).alias("n_dup_lines"), x["w"]["again"].alias("n_repeat_words"),
        x["l"]["n"].alias("n_lines"), (n - F.length(without(t, "!"))).cast("long").alias("n_bangs")))


#: Rules by bit, in this order for good: new ones are appended.  Each is true, over the measurements,
#: for a document that fails it.
RULES: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    ("few_words", lambda m: m["n_words"] < 50),
    ("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    ("long_words", lambda m: m["word_chars"] > 30 * m["n_words"]),
    ("symbols", lambda m: m["n_symbols"] > m["n_words"]),
    ("dup_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    ("shouting", lambda m: m["n_bangs"] > m["n_words"]),
)
BIT = {name: k for k, (name, _) in enumerate(RULES)}

#: Versioned policies: a document is kept if it fails none of the rules.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "long_words", "symbols", "dup_lines", "shouting"),
}


def mask(policy: str) -> int:
    return sum(1 << BIT[r] for r in POLICIES[policy])


def failures(m: Column) -> Column:
    """Bit k is set if rule k fails."""
    bits = [F.when(rule(m), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, rule) in enumerate(RULES)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, measurements and failed (bit k set: rule k fails)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), measurements(F.col(text_col)).alias("m"))
    return rows.select("doc_id", "m.*", failures(F.col("m")).alias("failed"))


def apply_policy(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Adds kept: no rule of the policy fails."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0)


def ablation(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail only it, and that the policy keeps
    without it.  The ledger is first counted by mask, at most 2^rules rows."""
    m = mask(policy)
    counts = rows.groupBy(F.col("failed").bitwiseAND(F.lit(m)).alias("bits")).agg(F.count("*").alias("n"))
    per_rule = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(1 << BIT[r]).cast("long").alias("bit")) for r in POLICIES[policy]]))
    x = counts.withColumn("r", per_rule)
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0
    return x.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(hit & rest, F.col("n")).otherwise(0)).alias("fails_alone"),
        F.sum(F.when(rest, F.col("n")).otherwise(0)).alias("kept_without"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(mask("base"))) != 0).alias("base_failed"), "kept",
        "n_lines", "n_bangs", "failed")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that policy v1 rejects, row by row: nothing is joined or moved.  The bits are
    one expression over one evaluation of the measurements."""
    return docs.where(let(measurements(F.col("text")), failures).bitwiseAND(F.lit(mask("v1"))) == 0)


#: SQL of the ledger over a table of documents (doc_id, text).
LEDGER_SQL = r"""
w AS (SELECT doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i,
        unnest(list_transform(range(1, len(ws) - 1), lambda k: ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2])) AS g FROM w),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM
        (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r WHERE c > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
        length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_bangs FROM w LEFT JOIN c USING (doc_id))
"""
OP4_SQL = "WITH " + LEDGER_SQL + r"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, failed = 0 AS kept,
  n_lines, n_bangs, failed
FROM (SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
  + 4 * (word_chars > 30 * n_words)::BIGINT + 8 * (n_symbols > n_words)::BIGINT
  + 16 * (2 * n_dup_lines > n_lines)::BIGINT + 32 * (n_bangs > n_words)::BIGINT)::BIGINT AS failed FROM m)
"""
