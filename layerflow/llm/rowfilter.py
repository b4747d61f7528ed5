"""Dropping rows of a table by their keys without moving the rows that stay.

A join that decides about whole documents shuffles every text as soon as the decided keys pass the broadcast
threshold.  Here the keys become a bitmap of at most ``MAX_BITS`` bits, built by Spark's own bitmap aggregation and
broadcast; a row whose bit is not set has no such key and stays where it is.  Only the others, the decided rows and
few more, are joined with the keys themselves.  A fuller bitmap lets more rows through to the join, never a wrong one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 28
BITS_A_KEY = 16


def key_bits(keys: DataFrame, key: Column) -> np.ndarray:
    """Bitmap of the 64-bit ``key`` of each row: a power of two of bits, 32 MB at most."""
    size = min(MAX_BITS, max(1 << 16, 1 << (BITS_A_KEY * keys.count()).bit_length()))
    place = key.bitwiseAND(F.lit(size - 1)) + 1      # Spark's bitmaps count from one
    parts = keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for r in parts.toLocalIterator():
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["bucket"] - 1) * len(part)
        out[at:at + len(part)] = part[:len(out) - at]
    return out


def may_be_in(docs: DataFrame, bits: np.ndarray, key: Column) -> Column:
    """Whether a row's 64-bit ``key`` can be one of those in ``bits``; only the key goes to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def hit(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
        packed = shared.value
        for k in keys:
            at = k.to_numpy(np.int64) & (8 * len(packed) - 1)
            yield pd.Series((packed[at >> 3] >> (at & 7) & 1).astype(bool))

    return hit(key)


def split(docs: DataFrame, keys: DataFrame, key: Column, own_key: Column) -> tuple[DataFrame, DataFrame]:
    """(rows of ``docs`` that may have a key of ``keys``, rows that have none).  ``key`` is the 64-bit key of
    a row of ``keys``, ``own_key`` that of a row of ``docs``, never NULL."""
    hit = may_be_in(docs, key_bits(keys, key), own_key)
    flag = next(n for n in ("_may", "_may_be", "_may_be_in") if n not in docs.columns)
    marked = docs.withColumn(flag, hit)
    return marked.where(flag).drop(flag), marked.where(~F.col(flag)).drop(flag)
