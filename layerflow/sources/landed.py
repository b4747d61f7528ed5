"""Which files of a drop folder a table has landed, so that a repeated run appends none twice.

A file is known by its path, size and modification time; the log table has two rows per landed file, in the order
``BEGIN`` (before the append) and ``DONE`` (the commit mark, after it).  A run lands the files of the drop that have no ``DONE``.
A file with a ``BEGIN`` but no ``DONE`` was being landed when its run was lost.  Only for such files the raw table is
asked for the rows of that file and run: as many as the file has, and only the mark was lost; none, and it is landed now;
anything between is an append that was cut off halfway, which fails by name.

The drop is listed through Spark; no file is opened for that.  A changed file (another size or time) is a new one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.operators import tables as tb
from layerflow.session import RunContext
from layerflow.sources.files import LINEAGE_COLUMNS, readable

BEGIN, DONE = "BEGIN", "DONE"
FILE, RUN = LINEAGE_COLUMNS[0], LINEAGE_COLUMNS[2]
VERSION = ["file", "size", "modified"]
LOG_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("size", T.LongType()),
    T.StructField("modified", T.TimestampType()), T.StructField("state", T.StringType()),
    T.StructField("job_run_id", T.StringType()), T.StructField("marked_at", T.TimestampType())])


def drop_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, size, modified) of a folder's files; their contents are not read."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"))


class PartialAppend(RuntimeError):
    """A lost run left some rows of a file in the table, but not all."""


@dataclass
class Landing:
    """The new files of one run; :meth:`commit` after their rows are in the table."""
    spark: SparkSession
    log: str
    run: RunContext
    rows: list[tuple]

    @property
    def files(self) -> list[str]:
        return [readable(r[0]) for r in self.rows]

    def mark(self, state: str, rows: list[tuple] | None = None) -> None:
        rows = self.rows if rows is None else rows
        if rows:
            df = self.spark.createDataFrame(rows, T.StructType(LOG_SCHEMA.fields[:3]))
            tb.append_rows(self.spark, self.log, df.withColumns({
                "state": F.lit(state), "job_run_id": F.lit(self.run.job_run_id),
                "marked_at": F.lit(self.run.run_ts).cast("timestamp")}))

    def commit(self) -> None:
        self.mark(DONE)


def begin_landing(spark: SparkSession, path: str | list[str], table: str, log: str, root: str, run: RunContext,
                  count_rows) -> Landing:
    """The files of ``path`` that ``table`` has not landed, marked ``BEGIN`` in ``log`` (created below
    ``root``).  ``count_rows(files)`` -> (file, n) of the rows that a landing of the files has."""
    tb.create_table(spark, log, LOG_SCHEMA, root)
    marks = spark.table(log)
    now = drop_files(spark, path).join(marks.where(F.col("state") == DONE).select(*VERSION).distinct(), VERSION, "left_anti")
    begun = marks.where(F.col("state") == BEGIN).groupBy(*VERSION).agg(F.collect_set("job_run_id").alias("runs"))
    found = [tuple(r) for r in now.join(begun, VERSION, "left").select(*VERSION, "runs").orderBy("file").collect()]
    landing = Landing(spark, log, run, [r[:3] for r in found])
    if lost := {r[0]: r[3] for r in found if r[3]}:
        complete = _complete(spark, table, lost, count_rows)
        landing.mark(DONE, [r[:3] for r in found if r[0] in complete])
        landing.rows = [r[:3] for r in found if r[0] not in complete]
    landing.mark(BEGIN)
    return landing


def _complete(spark: SparkSession, table: str, lost: dict[str, list[str]], count_rows) -> set[str]:
    """Files of lost runs whose rows are all in the table."""
    if not spark.catalog.tableExists(table):
        return set()
    asked = spark.createDataFrame([(f, r) for f, runs in lost.items() for r in runs], f"{FILE} string, {RUN} string")
    have = {r[FILE]: r["n"] for r in spark.table(table).join(asked, [FILE, RUN], "left_semi").groupBy(FILE).agg(
        F.count("*").alias("n")).collect()}
    if not have:
        return set()
    want = {r["file"]: r["n"] for r in count_rows([readable(f) for f in have]).collect()}
    for f, n in have.items():
        if n != want.get(f, 0):
            raise PartialAppend(f"{table} has {n} of {want.get(f, 0)} rows of {f}, left by a lost run")
    return set(have)
