"""Land every new CSV file of a drop folder into a raw table, incrementally.

The stream is one of *files*, not of lines: ``readStream`` keeps the list of files already seen in the
checkpoint, so each run (``availableNow``: process what is there, then stop) gets only new ones.  Each
micro-batch is landed like a batch: every file by the names in its own header, records with too few or too many
fields into the reject table, one append through the table's commit protocol.  A file that lacks a column
fails the batch by name.  After a failure between an append and the checkpoint's commit, the next run gets
that batch again as its first one; its files are in the tables already, by name, and are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from layerflow.operators import tables as tb
from layerflow.plans.transforms import land_checked
from layerflow.session import RunContext, shared_root
from layerflow.sources.files import LINEAGE_COLUMNS, readable

FILE = LINEAGE_COLUMNS[0]
FILES_A_BATCH = 1000
# Fixed value: the columns of Spark's file source; only the path is read.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


class Landed:
    """Rows that the appends of one run wrote; files of a repeated batch add nothing."""

    def __init__(self) -> None:
        self.rows = 0


def batch_appender(table: str, landed: Landed | None = None):
    """``foreachBatch`` function of one run.  Only a run's first batch can be a repeated one, so only
    that is compared with the file names in the table (one column is read)."""
    first = True

    def append_batch(batch: DataFrame, epoch_id: int) -> None:
        nonlocal first
        s = batch.sparkSession
        if first:
            done = s.table(table).select(F.col(FILE).alias("_landed")).distinct()
            batch = batch.join(done, batch[FILE] == F.col("_landed"), "left_anti")
        n = tb.append_rows(s, table, batch)
        first = False
        if landed is not None:
            landed.rows += n

    return append_batch


def file_lander(columns: Sequence[str], run: RunContext, table: str, landed: Landed | None = None,
                rejects: str | None = None, rejected: Landed | None = None):
    """``foreachBatch`` function over a stream of files.  Lines are rejected before the rows are appended:
    a failure between the two loses none, and the repeated batch rejects none twice."""
    append = batch_appender(table, landed)
    append_lines = batch_appender(rejects, rejected) if rejects else None

    def land_batch(batch: DataFrame, epoch_id: int) -> None:
        # at most FILES_A_BATCH names, the ones that the stream's own log keeps on the driver
        files = sorted(readable(r["file"]) for r in batch.select("file").collect())
        if not files:
            return
        rows, lines, _ = land_checked(batch.sparkSession, files, run, columns)
        if append_lines is not None:
            append_lines(lines, epoch_id)
        append(rows, epoch_id)

    return land_batch


def land_stream(spark: SparkSession, drop_folder: str, columns: Sequence[str], table: str,
                run: RunContext, checkpoint: str | None = None,
                max_files_per_trigger: int | None = None, landed: Landed | None = None,
                rejects: str | None = None, rejected: Landed | None = None) -> StreamingQuery:
    """``rejects``: an existing table for the malformed lines; without one they are left out."""
    files = (spark.readStream.schema(FILE_SCHEMA).format("binaryFile")
             .option("maxFilesPerTrigger", str(max_files_per_trigger or FILES_A_BATCH))
             .load(drop_folder).select(F.col("_metadata.file_path").alias("file")))
    ckpt = checkpoint or f"{shared_root(spark)}/layerflow/streams/{table.replace('.', '_')}"
    return (files.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", ckpt)
            .foreachBatch(file_lander(columns, run, table, landed, rejects, rejected)).start())


def land_available(spark: SparkSession, drop_folder: str, columns: Sequence[str], table: str,
                   run: RunContext, checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                   rejects: str | None = None, rejected: Landed | None = None) -> int:
    """Land the files not landed before, wait, and return the rows appended (``rejected`` gets the count
    of malformed lines)."""
    landed = Landed()
    q = land_stream(spark, drop_folder, columns, table, run, checkpoint, max_files_per_trigger, landed, rejects, rejected)
    q.awaitTermination()
    for name in filter(None, (table, rejects)):
        spark.catalog.refreshTable(name)
    return landed.rows
