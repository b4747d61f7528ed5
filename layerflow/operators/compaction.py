"""Small files of a table's partitions are packed into larger ones, right after an append or by hand.

A partition (an unpartitioned table is one) is packed when it has at least ``min_files`` files below ``small_bytes``; its
larger files, and all files of other partitions, are not touched.  Exactly the files that were listed are replaced, so
what another appender adds meanwhile stays.

The packed files are written aside first.  Then a journal names them and the files they stand for, and only then, partition
by partition, those are deleted and the packed ones moved in.  No row is lost by a failure: what the journal names is
finished by the next call, what has no journal is removed.  As with Spark's own overwrite of a partition, a reader that
lists a partition during its exchange (a few file operations) can miss rows of it; it finds them on its next read.

Files are listed by Spark; the names of the files to be replaced, no others, reach the driver.  Bucketed tables,
tables of another format and ranged tables are left alone.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.operators import tables as tb
from layerflow.sources.files import readable

ASIDE, JOURNAL = "_compact-", "journal.json"
_SLOT = "_slot"


@dataclass(frozen=True)
class AutoCompact:
    """When a partition is packed: so many files below so many bytes."""
    min_files: int = 16
    small_bytes: int = 32 << 20


class _Files:
    """The few file operations of an exchange, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = self.jvm.org.apache.hadoop.fs.Path(root)
        self.fs = self.root.getFileSystem(conf)

    def path(self, parent, name: str | None = None):
        make = self.jvm.org.apache.hadoop.fs.Path
        return make(parent) if name is None else make(parent, name)

    def of_uri(self, uri: str):
        return self.path(self.jvm.java.net.URI.create(uri))

    def below(self, path) -> list:
        return [s.getPath() for s in self.fs.listStatus(path)] if self.fs.exists(path) else []

    def write(self, path, text: str) -> None:
        aside = self.path(path.getParent(), f"{path.getName()}.part")
        out = self.fs.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.rename(aside, path)

    def read(self, path) -> str:
        stream = self.fs.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def small_files(spark: SparkSession, location: str, rule: AutoCompact) -> dict[str, list[str]]:
    """Folder -> its small files, of the folders that have enough of them."""
    folder = F.regexp_extract("file", "^(.*)/[^/]*$", 1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location).select(
        F.col("_metadata.file_path").alias("file"), F.col("length"))
    small = files.where(F.col("length") < rule.small_bytes).groupBy(folder.alias("folder")).agg(
        F.sort_array(F.collect_list("file")).alias("files"))
    return {r["folder"]: r["files"] for r in small.where(F.size("files") >= max(2, rule.min_files)).collect()}


def compact_appends(spark: SparkSession, name: str, rule: AutoCompact = AutoCompact()) -> int:
    """Packs the partitions of ``name`` that have too many small files; returns how many."""
    info = tb.table_info(spark, name)
    if info.get("Type") == "VIEW" or info.get("Provider", "").lower() != "parquet" or int(info.get("Num Buckets") or 0) > 0:
        return 0
    location = info["Location"]
    files = _Files(spark, location)
    finished = recover(spark, name, files)
    found = small_files(spark, location, rule)
    if found:
        aside = files.path(files.root, f"{ASIDE}{uuid.uuid4().hex[:12]}")
        _pack(spark, name, found, aside.toString())
        moves = []
        for slot, (folder, old) in enumerate(sorted(found.items())):
            new = [p.getName() for p in files.below(files.path(aside, f"{_SLOT}={slot}")) if p.getName().endswith(".parquet")]
            moves.append({"slot": slot, "folder": folder, "old": old, "new": new})
        files.write(files.path(aside, JOURNAL), json.dumps(moves))
        _exchange(files, aside, moves)
    if found or finished:
        spark.catalog.refreshTable(name)
    return len(found)


def _pack(spark: SparkSession, name: str, found: dict[str, list[str]], aside: str) -> None:
    """One job for all folders: their rows, in slots, in as many files as AQE's advisory size makes."""
    parts = tb.partition_columns(spark, name)
    schema = T.StructType([f for f in spark.table(name).schema.fields if f.name not in parts])
    slots = spark.createDataFrame([(f, k) for k, f in enumerate(sorted(found))], f"_folder string, {_SLOT} int")
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(
        *[readable(f) for own in found.values() for f in own])
    rows = rows.withColumn("_folder", F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)).join(slots, "_folder")
    rows.drop("_folder").hint("rebalance", _SLOT).write.partitionBy(_SLOT).parquet(aside)


def _exchange(files: _Files, aside, moves: list[dict]) -> None:
    """Every step can be done again: a file that is gone was deleted or moved before."""
    for m in moves:
        folder = files.of_uri(m["folder"])
        for old in m["old"]:
            files.fs.delete(files.of_uri(old), False)
        for new in m["new"]:
            source = files.path(files.path(aside, f"{_SLOT}={m['slot']}"), new)
            if files.fs.exists(source) and not files.fs.rename(source, files.path(folder, new)):
                raise OSError(f"could not move {source.toString()} to {m['folder']}")
    files.fs.delete(aside, True)


def recover(spark: SparkSession, name: str, files: _Files | None = None) -> int:
    """Finishes exchanges that a lost run had begun and removes what it had only written aside."""
    files, n = files or _Files(spark, tb.table_location(spark, name)), 0
    for aside in files.below(files.root):
        if aside.getName().startswith(ASIDE):
            journal = files.path(aside, JOURNAL)
            if files.fs.exists(journal):
                _exchange(files, aside, json.loads(files.read(journal)))
                n += 1
            else:
                files.fs.delete(aside, True)
    if n:
        spark.catalog.refreshTable(name)
    return n
