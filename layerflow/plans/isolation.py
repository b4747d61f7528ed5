"""One table's Spark jobs among those of others: a FAIR pool and a job tag of its own, and a time limit.

The pool and the tag are local properties of the thread that runs the table; Spark hands them on to the jobs it
starts for the thread (broadcasts and adaptive stages too).  With ``spark.scheduler.mode=FAIR`` the pools share the cluster's
cores, so a table with many tasks does not hold up a small one; without it they are only names.

At the limit the table's jobs are cancelled by their tag, again and again until its thread has noticed: a table between
two jobs has none to cancel, and is stopped at its next step instead.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

POOL = "spark.scheduler.pool"
AGAIN_SECONDS = 0.5


class TableTimeout(RuntimeError):
    """A table's run took longer than its limit; its jobs were cancelled."""


class TableJobs:
    """``with TableJobs(...) as jobs``: what the thread runs inside is in the table's pool, and under its
    limit inside ``with jobs.limited()``.  Audit events are written outside of that."""

    def __init__(self, spark: SparkSession, table_id: str, limit_seconds: float | None = None):
        self.sc, self.table_id, self.limit = spark.sparkContext, table_id, limit_seconds
        self.tag = f"layerflow-{uuid.uuid4().hex[:12]}"
        self._expired, self._done = threading.Event(), threading.Event()

    def __enter__(self) -> "TableJobs":
        self._pool = self.sc.getLocalProperty(POOL)
        self.sc.setLocalProperty(POOL, self.table_id)
        if self.limit is not None:
            threading.Thread(target=self._watch, daemon=True).start()
        return self

    def __exit__(self, *exc) -> None:
        self._done.set()
        self.sc.setLocalProperty(POOL, self._pool)

    def _watch(self) -> None:
        if self._done.wait(self.limit):
            return
        self._expired.set()
        while not self._done.is_set():
            self.sc.cancelJobsWithTag(self.tag)
            self._done.wait(AGAIN_SECONDS)

    @contextmanager
    def limited(self) -> Iterator[None]:
        """A step under the limit: past it, jobs fail and so does the step, as :class:`TableTimeout`."""
        self.sc.addJobTag(self.tag)
        try:
            self._check()
            yield
        except Exception as e:
            if self._expired.is_set() and not isinstance(e, TableTimeout):
                raise TableTimeout(self._text()) from e
            raise
        finally:
            self.sc.removeJobTag(self.tag)

    def _text(self) -> str:
        return f"{self.table_id}: over its limit of {self.limit} s"

    def _check(self) -> None:
        if self._expired.is_set():
            raise TableTimeout(self._text())
