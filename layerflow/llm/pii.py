"""Personal data [native]: high-recall generators propose spans, which may overlap; gradient-boosted
trees over format and context score them; a threshold per kind, calibrated on held-out findings,
selects what is redacted.

Spans of the four base kinds (email, ip, card, phone) that pass their check are always selected, and
those that fail it never; the model decides on what only the wider generators propose.  Labelled
findings: ``seed_findings``, made from a rule, and the base spans of the documents, positive if they
pass their kind's check (the check itself is no feature).  Fitted on a sample of at most
``MAX_TRAIN_DOCS`` documents and ``MAX_TRAIN_ROWS`` of their findings.

Defined results: a null or empty text has no spans; places are code points of the whole text; equal
rows give equal results; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import let, row_key, sample_of, table, without
from layerflow.llm.spans import matches
from layerflow.llm.trees import boosted_sql

MAX_TRAIN_DOCS = 40_000
MAX_TRAIN_ROWS = 20_000
PRECISION = 0.98
KINDS = ("email", "ip", "card", "phone")

#: The contract's patterns, written so that a run of characters is tried once (possessive, and only
#: from its start or the end of the match before): same matches, linear time on long runs.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider generators: spelled-out addresses, phones without a plus.
WIDE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+])(?<!\+[0-9]{1,3}[ .-]{1,2})\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
}


def _luhn(d: Column) -> Column:
    n = F.length(d)

    def step(acc: Column, i: Column) -> Column:
        v = F.substring(d, i, F.lit(1)).cast("int")
        return acc + F.when((n - i) % 2 == 1, v * 2 - F.when(v > 4, 9).otherwise(0)).otherwise(v)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def passes(kind: str, m: Column) -> Column:
    """The check of a base kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return ~F.exists(F.split(m, r"\."), lambda p: let(
            F.regexp_replace(p, "^0+", ""), lambda q: (F.length(q) > 3) | (F.coalesce(F.try_to_number(
                F.when((F.length(q) <= 3) & (q != ""), q), F.lit("999")), F.lit(0)) > 255)))
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    if kind == "card":
        return F.when(n.between(14, 19), let(digits, _luhn)).otherwise(False)
    return n.between(10, 15)


def _guard(kind: str, t: Column) -> Column | None:
    return {"email": F.contains(t, F.lit("@")), "phone": F.contains(t, F.lit("+"))}.get(kind)


def candidates(text: Column) -> Column:
    """array of (kind, s, e, ok, base, m, l, r); ok: passes its kind's check."""
    t = F.coalesce(text, F.lit(""))

    def of(kind: str, base: bool) -> Column:
        found = (matches(t, BASE[kind], _guard(kind, t)) if base else
                 matches(t, WIDE[kind], t.rlike(r"(?i)[\[(]at[\])]") if kind == "email" else None))
        return F.transform(found, lambda p: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), p["s"].alias("s"), p["e"].alias("e"),
            (passes(kind, p["m"]) if base else F.lit(False)).alias("ok"), F.lit(base).alias("base"),
            p["m"].alias("m"), p["l"].alias("l"), p["r"].alias("r")))

    return F.concat(*[of(k, True) for k in BASE], *[of(k, False) for k in WIDE])


NAMES = ["kind", "chars", "digits", "letters", "dots", "blanks", "dashes", "plus", "groups", "glued_left",
         "glued_right", "says_mail", "says_phone", "says_card", "says_ip", "says_number", "sentence"]


def _features(c: Column) -> dict[str, Column]:
    m, left, right = c["m"], c["l"], c["r"]
    digits = F.length(F.regexp_replace(m, "[^0-9]", ""))
    letters = F.length(F.regexp_replace(m, "[^A-Za-z]", ""))
    flag = lambda x: x.cast("int")
    return {
        "kind": c["kind"], "chars": F.length(m), "digits": digits, "letters": letters,
        "dots": F.length(m) - F.length(without(m, ".")), "blanks": F.length(m) - F.length(without(m, " ")),
        "dashes": F.length(m) - F.length(without(m, "-")), "plus": flag(F.startswith(m, F.lit("+"))),
        "groups": F.size(F.split(m, "[^A-Za-z0-9]+")),
        "glued_left": flag(left.rlike(r"[\p{L}\p{N}.]$")), "glued_right": flag(right.rlike(r"^[\p{L}\p{N}]")),
        "says_mail": flag(left.rlike("(?i)mail|contact|write")), "says_phone": flag(left.rlike("(?i)phone|tel|call|fax")),
        "says_card": flag(left.rlike("(?i)card|visa|iban|account")), "says_ip": flag(left.rlike("(?i)host|addr|server|\\bip\\b")),
        "says_number": flag(left.rlike("(?i)version|order|\\bid\\b|serial|no\\.")),
        "sentence": flag(right.rlike(r"^[.,;]?(\s|$)")),
    }


def _with_features(cands: Column) -> Column:
    return F.transform(cands, lambda c: F.struct(
        c["kind"].alias("k"), c["s"].alias("s"), c["e"].alias("e"), c["ok"].alias("ok"), c["base"].alias("base"),
        F.struct(*[v.cast("double").alias(n) for n, v in _features(c).items()]).alias("f")))




class Model:
    """Score as SQL over ``c.f`` and the thresholds by kind."""

    def __init__(self, score: str = "0D", thresholds: dict[int, float] | None = None):
        self.score, self.thresholds = score, thresholds or {}


def seed_findings(n: int = 80) -> list[tuple[str, int]]:
    """Labelled texts from a rule, each with one span of a wider generator: personal data in the usual
    contexts, and numbers and phrases that look like it."""
    out = []
    for i in range(n):
        a, b, c = 200 + (i * 37) % 700, 100 + (i * 53) % 900, 1000 + (i * 613) % 9000
        name, host = ("jo", "ann.lee", "k_m", "info", "max")[i % 5], ("example", "mail", "post-box")[i % 3]
        out += [(f"write to {name} [at] {host} [dot] org please", 1), (f"contact: {name}(at){host}.com", 1),
                (f"mail {name}{i} (at) {host} (dot) net, thanks", 1), (f"call ({a}) {b}-{c} now", 1),
                (f"tel. {a}-{b}-{c}.", 1), (f"phone {a} {b} {c}, ask for {name}", 1), (f"fax: {a}.{b}.{c}", 1),
                (f"order {a} {b} {c} shipped", 0), (f"serial no. {a}-{b}-{c} x", 0), (f"version {a}.{b}.{c} of it", 0),
                (f"id {a}-{b}-{c}a", 0), (f"look (at) {host}.see above", 0), (f"he was {name} (at) home . then left", 0)]
    return out


def fit(docs: DataFrame, text_col: str = "text", seed: int = 7) -> Model:
    """Boosted trees on half of the findings; the thresholds on the other half's wide spans: per kind
    the lowest score from which they are right at least ``PRECISION`` of the time."""
    sampled = sample_of(docs, row_key(docs, text_col), MAX_TRAIN_DOCS).select(F.col(text_col).alias("text"))
    found = sampled.select(F.explode(_with_features(candidates(F.col("text")))).alias("c")).where("c.base")
    h = F.xxhash64("c.s", "c.e", *[f"c.f.{n}" for n in NAMES])
    cols = ["c.k", "c.base", "c.f.*", h.alias("h")]
    rows = found.select(F.col("c.ok").cast("double").alias("label"), *cols).orderBy("h").limit(MAX_TRAIN_ROWS)
    seeds = docs.sparkSession.createDataFrame(seed_findings(), "text string, label int").select(
        F.col("label").cast("double"), F.explode(_with_features(candidates(F.col("text")))).alias("c")).where("NOT c.base")
    rows = rows.unionByName(seeds.select("label", *cols)).withColumn("half", F.pmod("h", F.lit(2))).cache()
    try:
        train = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows.where("half = 0").coalesce(2))
        gbt = GBTClassifier(maxIter=8, maxDepth=4, maxBins=32, seed=seed).fit(train)
        score = boosted_sql(gbt, [f"c.f.{n}" for n in NAMES])
        held = rows.where("half = 1 AND NOT base").select("k", "label", F.struct(F.struct(*NAMES).alias("f")).alias("c"))
        bins = held.select("k", "label", F.floor(F.expr(score) * 50).alias("bin")).groupBy("k", "bin").agg(
            F.count("*").alias("n"), F.sum("label").alias("pos")).collect()
    finally:
        rows.unpersist()
    thresholds = {}
    for k in range(len(KINDS)):
        n = pos = 0.0
        for r in sorted((r for r in bins if r["k"] == k), key=lambda r: -r["bin"]):
            n, pos = n + r["n"], pos + r["pos"]
            if pos < PRECISION * n:
                break
            if n >= 20:
                thresholds[k] = r["bin"] / 50
    return Model(score, thresholds)


def detect(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, spans: array of (s, k, e, base) by start, then kind; base: passes its kind's check."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", _with_features(candidates(F.col("text"))).alias("cands"))
    limit = " ".join(f"WHEN {k} THEN {t!r}D" for k, t in model.thresholds.items())
    chosen = f"(NOT c.base AND ({model.score}) >= CASE c.k {limit} ELSE 2D END)" if limit else "false"
    spans = F.expr(f"""array_sort(array_distinct(transform(
        filter(cands, c -> c.ok OR {chosen}),
        c -> named_struct('s', c.s, 'k', c.k, 'e', c.e, 'base', c.ok))))""")
    return rows.select("doc_id", spans.alias("spans"))


def redact(text: Column, spans: Column, mark: str = "[PII]") -> Column:
    """The text with each selected span replaced; overlapping spans become one mark."""
    return F.concat(F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, x: F.struct(
            F.greatest(a["at"], x["e"]).alias("at"),
            F.when(x["s"] < a["at"], a["out"]).otherwise(F.concat(
                a["out"], F.substring(text, a["at"] + 1, x["s"] - a["at"]), F.lit(mark))).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))))


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(name, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = detect(docs, fit(docs)).select("doc_id", "spans", F.filter("spans", lambda x: x["base"]).alias("own"))
    return rows.select(
        "doc_id",
        *[F.size(F.filter(F.col("own")["k"], lambda k: k == F.lit(n))).cast("long").alias(f"n_{name}")
          for n, name in enumerate(KINDS)],
        F.sha2(_joined(F.col("own")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
