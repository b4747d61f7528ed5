"""Secret scan [native]: long unbroken tokens are candidates; a random forest over their length,
character transitions, dictionary coverage, path and neighbouring words removes false positives.

Labelled findings (text, path, label) train the forest.  By default they are ``seed_findings``, made
from a rule, and weakly labelled candidates of the documents themselves: a token that is assigned to a
credential word is a positive finding, one in running prose a negative one.  The sample is bounded by
``MAX_TRAIN_DOCS`` documents and ``MAX_TRAIN_ROWS`` findings.  The dictionary (frequent letter
trigrams of words) is counted over all documents.

Defined results: a null or empty text has no candidates; places are code points of the whole text; a
null path has no path features; equal rows give equal results; other columns are ignored (the stage
keeps them); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import let, row_key, sample_of, table
from layerflow.llm.spans import pieces
from layerflow.llm.trees import forest_sql

MAX_TRAIN_DOCS = 40_000
MAX_TRAIN_ROWS = 20_000
DICT_SIZE = 1_500
MARK = "[SECRET]"

#: A run of at least 16 token characters with its padding; only whole runs are tried.
TOKEN = r"(?<![A-Za-z0-9_+/\-])[A-Za-z0-9_+/\-]{16,}+={0,2}"
CREDENTIAL = r"(?i)(key|token|secret|passw(or)?d|pwd|auth|credential|bearer)[\"']?\s*[:= ]\s*[\"']?$"
NAMES = ["chars", "digit_share", "upper_share", "hex_only", "to_digit", "to_upper", "distinct_share",
         "joints", "covered", "credential", "assigned", "quoted", "harmless", "test_path", "doc_path"]


def candidate_pieces(text: Column) -> Column:
    return pieces(F.coalesce(text, F.lit("")), TOKEN)


def _features(c: Column, path: Column, trigrams: Column) -> dict[str, Column]:
    m, left, right = F.coalesce(c["m"], F.lit("")), c["l"], c["r"]
    n = F.greatest(F.length(m), F.lit(1))
    count = lambda p: F.regexp_count(m, F.lit(p))
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("int")
    low = F.lower(m)
    own = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(m) - 2, F.lit(1))),
                                       lambda i: F.substring(low, i, F.lit(3))))
    return {
        "chars": F.length(m), "digit_share": count("[0-9]") / n, "upper_share": count("[A-Z]") / n,
        "hex_only": flag(m.rlike("^[0-9a-fA-F-]+$")),
        "to_digit": count("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])") / n,
        "to_upper": count("[a-z](?=[A-Z])") / n,
        "distinct_share": F.size(F.array_distinct(F.split(m, ""))) / n,
        "joints": count("[_+/=-]") / n,
        "covered": let(own, lambda o: F.size(F.array_intersect(o, trigrams)) / F.size(o)),
        "credential": flag(left.rlike(CREDENTIAL)), "assigned": flag(left.rlike(r"[:=]\s*[\"']?$")),
        "quoted": flag(left.rlike("[\"']$") & right.rlike("^[\"']")),
        "harmless": flag(left.rlike("(?i)(example|sample|dummy|uuid|sha|md5|commit|checksum|hash)\\W*$")),
        "test_path": flag(path.rlike("(?i)test|spec|fixture|example")), "doc_path": flag(path.rlike("(?i)doc|readme|wiki")),
    }


def with_features(docs: DataFrame, trigrams: list[str], path_col: str | None) -> DataFrame:
    """Adds pieces: array of (g, m, s, e, f), f the features; docs has text, all its columns stay."""
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    grams = F.lit(trigrams or [""])
    return docs.withColumn("pieces", F.transform(candidate_pieces(F.col("text")), lambda c: F.struct(
        c["g"].alias("g"), c["m"].alias("m"), c["s"].alias("s"), c["e"].alias("e"),
        F.when(c["m"].isNotNull(), F.struct(*[
            v.cast("double").alias(k) for k, v in _features(c, path, grams).items()])).alias("f"))))


def dictionary(docs: DataFrame, text_col: str = "text") -> list[str]:
    """The ``DICT_SIZE`` most frequent letter trigrams of the words of all documents."""
    words = docs.select(F.col(text_col).alias("text")).select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")).alias("w"))
    grams = words.where(F.length("w") >= 3).groupBy("w").count().select("count", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("w") - 2), lambda i: F.substring("w", i, F.lit(3)))).alias("g"))
    top = grams.groupBy("g").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "g").limit(DICT_SIZE)
    return [r["g"] for r in top.collect()]


def seed_findings(n: int = 240) -> list[tuple[str, str, int]]:
    """Labelled findings from a rule: credentials in the usual contexts, and what looks like them."""
    out = []
    for i in range(n):
        h = hashlib.sha256(f"finding-{i}".encode()).hexdigest()
        mixed = "".join(c.upper() if int(h[k], 16) > 7 else c for k, c in enumerate(h))
        key = ("api_key", "token", "secret", "password", "AUTH_TOKEN")[i % 5]
        out += [(f'see {key} = "{h[:40]}" here', "src/app", 1), (f"{key}: {mixed[:24 + i % 20]}", "conf", 1),
                (f"Bearer token {mixed[:32]}", "notes", 1), (f"x AKIA{mixed[:16].upper()} y", "src/app", 1),
                (f"commit {h[:40]} fixes it", "docs", 0), (f"sha256 {h}", "docs/readme", 0),
                (f"uuid {h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}", "src", 0),
                (f"the order number {int(h[:14], 16):017d} shipped", "mail", 0),
                ("an " + ("internationalisation", "unverhältnismäßigkeitenlehre", "anticonstitutionnellement",
                          "characteristically-speaking", "some_long_function_name", "path/to/some/module/file")[i % 6]
                 + " of it", "docs", 0), (f"{key} = xxxxxxxxxxxxxxxxxxxx{'x' * (i % 9)}", "example", 0)]
    return out


class Model:
    def __init__(self, score: str = "0D", trigrams: list[str] | None = None, threshold: float = 0.5):
        self.score, self.trigrams, self.threshold = score, trigrams or [], threshold


def fit(docs: DataFrame, findings: DataFrame | None = None, path_col: str | None = None, seed: int = 7) -> Model:
    """``findings`` has text (the finding with its context), path and label; default: see above."""
    spark = docs.sparkSession
    grams = dictionary(docs)
    if findings is None:
        findings = spark.createDataFrame(seed_findings(), "text string, path string, label int")
        text = sample_of(docs, row_key(docs), MAX_TRAIN_DOCS).select(
            "text", (F.col(path_col).cast("string") if path_col else F.lit("")).alias("path"))
        weak = with_features(text, grams, "path").select(
            F.explode("pieces").alias("c")).where("c.m IS NOT NULL").select(
            "c.f.*", F.when((F.col("c.f.credential") > 0) & (F.col("c.f.covered") < 0.5) & (F.col("c.f.to_digit") > 0.1), 1)
            .when((F.col("c.f.credential") == 0) & (F.col("c.f.digit_share") == 0), 0).alias("label"))
        weak = weak.where("label IS NOT NULL").withColumn("h", F.xxhash64(*NAMES)).orderBy("h").limit(MAX_TRAIN_ROWS).drop("h")
    else:
        weak = None
    rows = with_features(findings, grams, "path").select("label", F.explode("pieces").alias("c")).where(
        "c.m IS NOT NULL").select("c.f.*", "label")
    if weak is not None:
        rows = rows.unionByName(weak.select(*rows.columns))
    train = VectorAssembler(inputCols=NAMES, outputCol="features").transform(
        rows.withColumn("label", F.col("label").cast("double"))).select("features", "label").coalesce(2).cache()
    try:  # the fit reads its bounded rows several times; the texts are read for the first of them
        forest = RandomForestClassifier(numTrees=15, maxDepth=6, maxBins=32, seed=seed).fit(train)
    finally:
        train.unpersist()
    return Model(forest_sql(forest, [f"c.f.{n}" for n in NAMES]), grams)


def scored(docs: DataFrame, model: Model, path_col: str | None = None) -> DataFrame:
    """Adds pieces: array of (g, m, s, e, score, secret); g and m in order are the text."""
    rows = with_features(docs, model.trigrams, path_col)
    return rows.withColumn("pieces", F.expr(f"""transform(transform(pieces, c -> named_struct(
        'g', c.g, 'm', c.m, 's', c.s, 'e', c.e, 'score', CASE WHEN c.m IS NULL THEN 0D ELSE {model.score} END)),
        p -> named_struct('g', p.g, 'm', p.m, 's', p.s, 'e', p.e, 'score', p.score,
                          'secret', p.m IS NOT NULL AND p.score >= {model.threshold!r}D))"""))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: candidates, findings the forest keeps, and their places and scores."""
    docs = table(spark, sf_dir, "documents")
    rows = scored(docs.select("doc_id", "text", "source"), fit(docs, path_col="source"), "source")
    rows = rows.select("doc_id", (F.size("pieces") - 1).cast("long").alias("n_candidates"),
                       F.filter("pieces", lambda p: p["secret"]).alias("found"))
    return rows.select(
        "doc_id", "n_candidates", F.size("found").cast("long").alias("n_secrets"),
        F.array_join(F.transform("found", lambda p: F.concat_ws(
            ":", p["s"].cast("string"), p["e"].cast("string"))), ",").alias("spans"),
        F.round(F.array_max(F.transform("found", lambda p: p["score"])), 6).alias("top_score"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each secret becomes ``MARK``; n_chars follows; every document stays."""
    path = "source" if "source" in docs.columns else None
    own = docs.select(F.struct(*docs.columns).alias("doc"), "text", *([path] if path else []))
    rows = scored(own, fit(docs, path_col=path), path)
    clean = F.array_join(F.transform("pieces", lambda p: F.concat(
        p["g"], F.when(p["secret"], F.lit(MARK)).otherwise(F.coalesce(p["m"], F.lit(""))))), "")
    text = F.when(F.exists("pieces", lambda p: p["secret"]), clean).otherwise(F.col("text"))
    out = rows.select("doc", text.alias("new_text")).withColumn("doc", F.col("doc").withField("text", F.col("new_text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("doc", F.col("doc").withField(
            "n_chars", F.length("new_text").cast(docs.schema["n_chars"].dataType)))
    return out.select("doc.*")
