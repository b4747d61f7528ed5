"""Helpers that several operators share: table reads and column expressions."""

from __future__ import annotations

import ctypes
import functools
import inspect
from collections.abc import Callable

import pyarrow
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the query contracts: the six ASCII blanks, and a word as a Java pattern.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: a lambda variable is not
    inlined, whereas a column used in another lambda would be evaluated per element."""
    return F.transform(F.array(value), body)[0]


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def row_key(df: DataFrame, text_col: str = "text") -> Column:
    """A hash to sample rows by: of the id where there is one, so that copies of a text are apart."""
    return F.xxhash64(*[c for c in ("doc_id", "page_id", text_col) if c in df.columns])


def sample_of(df: DataFrame, key: Column, max_rows: int) -> DataFrame:
    """A training sample of about ``max_rows`` rows, picked by a hash of ``key``: the same rows
    whatever the partitioning.  All rows when there are fewer.  Only models are fitted on it."""
    n = df.count()
    if n <= max_rows:
        return df
    return df.where(F.xxhash64(key, F.lit(17)).bitwiseAND(F.lit(2**62 - 1)) < F.lit(int(2**62 * max_rows / n)))


def _release() -> None:
    pyarrow.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(fn):
    """For functions of ``mapInPandas`` and ``applyInPandas``: when one is done, its freed memory goes back to
    the system.  Spark keeps Python workers for later tasks, and an executor's limit counts them all."""
    if inspect.isgeneratorfunction(fn):
        @functools.wraps(fn)
        def run(parts):
            yield from fn(parts)
            _release()
    else:
        @functools.wraps(fn)
        def run(group):
            out = fn(group)
            _release()
            return out
    return run
