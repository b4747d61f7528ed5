"""Matches of a pattern with their places, as plain column expressions (no Python on executors).

Spark returns matches without places; the pieces between the matches give them.  Running sums go
over blocks of matches, so a text with very many matches costs no square of their number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerflow.llm.common import let

BLOCK = 256
#: code points of context kept on each side of a match
LEFT, RIGHT = 40, 20
PIECE = "struct<g:string,m:string,s:int,e:int,l:string,r:string>"


def pieces(text: Column, pattern: str, guard: Column | None = None) -> Column:
    """array of (g, m, s, e, l, r): the text before a match and after the one before it, the match,
    its start and end in code points, and its context.  The last piece has no match (m null) and
    g is the rest of the text, so the g and m in order are the text.  Where ``guard`` is false the
    pattern cannot match and is not tried."""

    def located(m: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        zipped = let(gaps, lambda g: F.arrays_zip(g.alias("g"), m.alias("m"), F.slice(g, 2, F.size(g)).alias("n")))

        def block(acc: Column, part: Column) -> Column:
            inner = F.aggregate(
                part, F.struct(acc["pos"].alias("pos"), F.array().cast(f"array<{PIECE}>").alias("out")),
                lambda a, p: F.struct(
                    (a["pos"] + F.length(p["g"]) + F.coalesce(F.length(p["m"]), F.lit(0))).alias("pos"),
                    F.array_append(a["out"], F.struct(
                        p["g"].alias("g"), p["m"].alias("m"),
                        (a["pos"] + F.length(p["g"])).alias("s"),
                        (a["pos"] + F.length(p["g"]) + F.coalesce(F.length(p["m"]), F.lit(0))).alias("e"),
                        F.right(p["g"], F.lit(LEFT)).alias("l"),
                        F.left(F.coalesce(p["n"], F.lit("")), F.lit(RIGHT)).alias("r")).cast(PIECE)).alias("out")))
            return let(inner, lambda x: F.struct(
                x["pos"].alias("pos"), F.array_append(acc["out"], x["out"]).alias("out")))

        def blocks(z: Column) -> Column:
            parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(z) - 1) / BLOCK).cast("int")),
                                lambda k: F.slice(z, k * BLOCK + 1, F.lit(BLOCK)))
            start = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<array<{PIECE}>>").alias("out"))
            return F.flatten(F.aggregate(parts, start, block)["out"])

        none = F.array(F.struct(
            text.alias("g"), F.lit(None).cast("string").alias("m"), F.length(text).alias("s"),
            F.length(text).alias("e"), F.lit("").alias("l"), F.lit("").alias("r")).cast(PIECE))
        return F.when(F.size(m) == 0, none).otherwise(let(zipped, blocks))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if guard is not None:
        found = F.when(guard, found).otherwise(F.array().cast("array<string>"))
    return let(found, located)


def matches(text: Column, pattern: str, guard: Column | None = None) -> Column:
    return F.filter(pieces(text, pattern, guard), lambda p: p["m"].isNotNull())
