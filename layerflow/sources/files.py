"""CSV landing: header files read by column name as all-STRING columns plus lineage.

Headers are checked and read by the executors.  One job opens every file of a drop under the declared
columns and stops at its first row; when all agree, that is all.  Only when one does not, a second pass
reads the first line of every file, one task a file, and files are read by the names in their own header.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.session import RunContext

# The lineage columns every raw table carries.
LINEAGE_COLUMNS = ("source_file_name", "ingestion_timestamp", "job_run_id")
#: The raw line of a record with too few or too many fields, in frames read with ``malformed=True``.
RAW_LINE = "_raw_line"
_FILE_A_TASK = {"spark.sql.files.maxPartitionBytes": str(1 << 40), "spark.sql.files.openCostInBytes": str(1 << 40)}


def all_string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _session(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    """A session of the same context with settings of its own; the caller's stay as they are."""
    s = spark.newSession()
    for k, v in {**_FILE_A_TASK, **conf}.items():
        s.conf.set(k, v)
    return s


def headers_agree(spark: SparkSession, path: str | list[str], columns: Sequence[str], **options) -> bool:
    """Whether every file's header is ``columns``, by Spark's own check on the executors.  Taking one row
    with a first wave of all partitions, one file each, opens every file and reads its first rows only."""
    s = _session(spark, {"spark.sql.limit.initialNumPartitions": str(1 << 30)})
    r = s.read.option("header", "true").option("enforceSchema", "false").options(**options)
    try:
        r.schema(all_string_schema(columns)).csv(path).head(1)
    except (PySparkException, Py4JJavaError) as e:
        if "CSV header" not in str(e):
            raise
        return False
    return True


def readable(file: str) -> str:
    """A path for a reader, from the encoded one in ``_metadata.file_path``."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))


def header_layouts(spark: SparkSession, path: str | list[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Files by their header; files without a line have none and are left out.  One task a file reads its
    first line that is not blank, and stops."""

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, line in enumerate(b.column(0).to_pylist()):
                if line and line.strip("\ufeff \t"):
                    yield b.slice(k, 1)
                    return

    s = _session(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "16"})
    lines = s.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    found = lines.mapInArrow(first_line, "value string, file string").groupBy("value").agg(
        F.sort_array(F.collect_list("file")).alias("files"))
    out: dict[tuple[str, ...], list[str]] = {}
    for r in found.orderBy("files").collect():
        head = tuple(next(csv.reader([r["value"].lstrip("\ufeff")], delimiter=sep), ()))
        out.setdefault(head, []).extend(readable(f) for f in r["files"])
    return out


def read_csv_strings(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None,
                     malformed: bool = False, **options) -> DataFrame:
    """Header CSV, every column STRING, no inference pass.

    Each file is read by the names in its own header, whatever their order; columns beyond ``columns``
    (default: those of the first file) are left out, and a file that lacks one fails here, by name.  Files
    with the same header are one read.  A record with fewer fields than its header is padded with NULLs, one
    with more is cut; ``malformed`` adds its whole line as ``_raw_line`` (NULL for other records)."""
    r = spark.read.option("header", "true").option("inferSchema", "false").options(**options)
    if columns is None:
        columns = r.csv(path).columns
    layouts: dict[tuple[str, ...], str | list[str]] = {tuple(columns): path}
    if columns and not headers_agree(spark, path, columns, **options):
        layouts = header_layouts(spark, path, options.get("sep", ","))
    for head, files in layouts.items():
        if missing := [c for c in columns if c not in head]:
            raise ValueError(f"{files[0]} (and {len(files) - 1} more) lacks columns {missing}")
    parts = []
    for head, files in layouts.items():
        schema = all_string_schema(head)
        if malformed:
            schema = schema.add(RAW_LINE, T.StringType())
            # a record's fields can only be counted when none of them is pruned from the scan
            r = r.option("columnNameOfCorruptRecord", RAW_LINE).option("columnPruning", "false")
        # Spark checks each file's header against the names it was grouped by
        df = r.schema(schema).option("enforceSchema", "false").csv(files)
        one = F.col(f"`{head[0]}`")   # NULL added: Spark refuses a query of the raw line alone
        line = [F.coalesce(F.col(RAW_LINE), F.nullif(one, one)).alias(RAW_LINE)] if malformed else []
        parts.append(df.select(*[F.col(f"`{c}`") for c in columns], *line, "_metadata"))
    return reduce(DataFrame.unionByName, parts)


def with_lineage(df: DataFrame, run: RunContext, source_name: str | None = None,
                 job_run_id: str | None = None) -> DataFrame:
    """Add ``source_file_name`` (file path from the scan's ``_metadata`` for
    file sources, else ``source_name``), ``ingestion_timestamp`` (the run's
    fixed time) and ``job_run_id`` in one projection."""
    src: Column = F.lit(source_name) if source_name is not None else F.col("_metadata.file_path")
    return df.withColumns({
        "source_file_name": src.cast("string"),
        "ingestion_timestamp": F.lit(run.run_ts).cast("timestamp"),
        "job_run_id": F.lit(job_run_id or run.job_run_id).cast("string"),
    }).drop("_metadata")


def stage_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write ``df`` as header CSV keeping leading/trailing spaces (Spark's CSV
    writer strips them by default).  Used to land sources into a drop folder;
    ``mode="append"`` adds new files to an existing one."""
    (df.write.mode(mode)
       .option("header", "true")
       .option("ignoreLeadingWhiteSpace", "false")
       .option("ignoreTrailingWhiteSpace", "false")
       .csv(path))
    return path
