"""Connected components of an edge table, without collecting it anywhere.

Each task first reduces its own share of the edges, at most about ``SHARE`` of them, to a spanning forest.
A graph that is one share is done then.  Otherwise rounds of large star and small star follow (each node's
neighbours are tied to the least of them) until nothing changes.  Every round is a table below the shared
folder, so its lineage is one read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerflow.llm.common import lean
from layerflow.session import scratch_dir

MAX_ROUNDS = 60
SHARE = 1_000_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for the edges a-b, roots left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:  # hook the larger root below the smaller, then shorten all paths
        p, q = root[x], root[y]
        open_ = p != q
        if not open_.any():
            break
        x, y, p, q = x[open_], y[open_], p[open_], q[open_]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while not np.array_equal(short := root[root], root):
            root = short
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


@lean
def _batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        a, b = forest(p["a"].to_numpy(), p["b"].to_numpy())
        yield pd.DataFrame({"a": a, "b": b})


@lean
def _share(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    a, b = forest(*(np.concatenate(x) for x in zip(*((p["a"].to_numpy(), p["b"].to_numpy()) for p in parts),
                                                   (np.zeros(0, np.int64),) * 2)))
    yield pd.DataFrame({"a": a, "b": b})


def components(edges: DataFrame, share: int = SHARE) -> DataFrame:
    """(node, root) for every node with an edge but the roots themselves; root is the least node of
    the component.  ``edges`` has a and b (long, not null), in either order."""
    spark, folder = edges.sparkSession, scratch_dir(edges.sparkSession, "components")

    def kept(df: DataFrame, k: object) -> tuple[DataFrame, int]:
        df.write.parquet(f"{folder}/{k}")
        out = spark.read.schema("a long, b long").parquet(f"{folder}/{k}")
        return out, out.count()

    e, n = kept(edges.select("a", "b").where("a <> b").mapInPandas(_batches, "a long, b long"), "edges")
    shares = -(-n // share)
    e, n = kept(e.coalesce(max(1, shares)).mapInPandas(_share, "a long, b long"), "shares")
    if shares <= 1:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for k in range(1, MAX_ROUNDS):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, n_before = e, n
        e, n = kept(small.unionByName(below.select("a", F.col("m").alias("b"))).distinct(), k)
        if n == n_before and e.join(before, ["a", "b"], "left_anti").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
