"""WARC archives in Zstandard (.warc.zst): writer and reader.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself
compressed; then one frame per record.  The reader loads the dictionary, decodes frame by frame as a
stream (one record in memory at a time) and checks version, required headers, the block's length
against Content-Length, the end of the record and the block's and payload's SHA-1.

Of pages with equal payloads of at least ``min_bytes`` bytes, the one with the smallest id is a
response, the others are revisits of it: headers only, with the full payload's digest and length.
Archives are written below the shared folder by one task each under a name of their own, then
renamed, so a repeated task leaves the same archives; the list of the archives is a table there.

Defined results: a null html is an empty payload; pages with equal ids and payloads are both the
response if their id is the smallest; a null id is written as an empty one, read back as null and is never
what others refer to, unless all ids of a payload are null; other columns are ignored; no pages: no
archives, no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import lean, row_key, sample_of, table
from layerflow.session import scratch_dir

MAGIC = 0x184D2A5D
DICT_BYTES = 32_768
#: the dictionary is trained on so many pages at most, and so many bytes of each
DICT_PAGES, DICT_PAGE_BYTES = 400, 16_384
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 20
SALTS = 16
VERSION = "WARC/1.1"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
DATE = "2024-01-01T00:00:00Z"  # fixed, so that a repeated task writes the same bytes


class WarcError(ValueError):
    """An archive that is not what it says it is."""


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, page_id: int | None, payload: bytes, refers_to: int | None, url: str) -> bytes:
    name = "" if page_id is None else str(page_id)
    block = b"" if kind == "revisit" else (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
        + str(len(payload)).encode() + b"\r\n\r\n" + payload)
    headers = {
        "WARC-Type": kind, "WARC-Record-ID": f"<urn:page:{name}>", "WARC-Date": DATE,
        "WARC-Target-URI": "".join(url.split()),
        "WARC-Payload-Digest": "sha1:" + digest32(payload), "WARC-Payload-Length": str(len(payload)),
        "WARC-Block-Digest": "sha1:" + digest32(block),
        "Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    if kind == "revisit":
        headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        headers["WARC-Refers-To"] = f"<urn:page:{'' if refers_to is None else refers_to}>"
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; raises ``WarcError`` unless everything fits."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"no WARC record: {lines[0][:40]!r}")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        key, colon, value = line.partition(":")
        if not colon:
            raise WarcError(f"bad header line {line[:60]!r}")
        headers[key] = value.strip()
    for key in REQUIRED:
        if key not in headers:
            raise WarcError(f"{key} is missing")
    if not headers["Content-Length"].isdigit():
        raise WarcError("Content-Length is no number")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError(f"block of {len(rest) - 4} bytes, Content-Length {length}")
    block = rest[:length]
    if headers.get("WARC-Block-Digest", "sha1:" + digest32(block)) != "sha1:" + digest32(block):
        raise WarcError("block digest differs")
    if headers["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if headers.get("WARC-Payload-Digest", "sha1:" + digest32(payload)) != "sha1:" + digest32(payload):
            raise WarcError("payload digest differs")
        if int(headers.get("WARC-Payload-Length", len(payload))) != len(payload):
            raise WarcError("payload length differs")
    elif headers["WARC-Type"] == "revisit" and "WARC-Refers-To" not in headers:
        raise WarcError("a revisit refers to nothing")
    return headers, block


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
    return struct.pack("<II", MAGIC, len(packed)) + packed


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an open archive.  Each frame must hold exactly one record; a cut or damaged archive
    raises ``WarcError``."""
    head = stream.read(8)
    if len(head) < 8:
        raise WarcError("archive is too short")
    magic, size = struct.unpack("<II", head)
    if magic != MAGIC:
        raise WarcError("no leading skippable frame with the dictionary")
    packed = stream.read(size)
    if len(packed) != size:
        raise WarcError("the dictionary is cut short")
    try:
        raw = zstandard.ZstdDecompressor().decompress(packed) if packed[:4] == zstandard.FRAME_HEADER else packed
        own = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
        rest = b""
        while rest or (rest := stream.read(READ_BYTES)):
            frame, parts = own.decompressobj(), []
            while True:
                parts.append(frame.decompress(rest))
                if frame.eof:
                    rest = frame.unused_data
                    break
                rest = stream.read(READ_BYTES)
                if not rest:
                    raise WarcError("the last frame is cut short")
            yield parse(b"".join(parts))
    except zstandard.ZstdError as e:
        raise WarcError(f"damaged frame: {e}") from e


def train_dictionary(pages: DataFrame, html_col: str = "html") -> bytes:
    """From the starts of at most ``DICT_PAGES`` pages; empty if there is too little to learn from."""
    rows = sample_of(pages, row_key(pages, html_col), DICT_PAGES).select(
        F.substring(F.coalesce(html_col, F.lit("")), 1, DICT_PAGE_BYTES).alias("h")).where("h <> ''").limit(2 * DICT_PAGES).collect()
    heads = [r["h"].encode("utf-8", "surrogatepass") for r in rows]
    if len(heads) < 8 or sum(map(len, heads)) < 16 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, heads)) // 8), heads).as_bytes()
    except zstandard.ZstdError:  # too alike to learn from
        return b""


def _open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def mark_revisits(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", html_col: str = "html",
                  url_col: str | None = "url") -> DataFrame:
    """page_id, html, url, first (the response's id for equal payloads) and lone (no equal payload).

    Only payloads that occur more than once are joined.  Their table has one row a payload, made with
    partial aggregation; it is repeated for each salt, and the pages spread over the salts, so that a
    payload of a third of all pages is split over tasks."""
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        (F.coalesce(F.col(url_col), F.lit("")) if url_col else F.lit("")).alias("url"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    groups = rows.where(F.octet_length("html") >= min_bytes).groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    ).where("n > 1").select(
        F.col("sha").alias("g_sha"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("g_salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return rows.join(groups, (F.col("sha") == F.col("g_sha")) & (F.col("salt") == F.col("g_salt")), "left").select(
        "page_id", "html", "url", "first", F.col("g_sha").isNull().alias("lone"))


def write_archives(marked: DataFrame, folder: str, dictionary: bytes, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives below ``folder`` and returns their list (path, records, bytes), itself kept
    as a table there."""
    @lean
    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _open_fs(folder)
        part, out, listed = TaskContext.get().partitionId(), None, []
        zdict = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=zdict)

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                store.move(temp, final)
                listed.append((final, records, size))
                out = None

        for p in parts:
            for page_id, html, url, first, lone in zip(*(p[c] for c in ("page_id", "html", "url", "first", "lone"))):
                if out is None:
                    final = f"{base}/pages-{part:05d}-{len(listed):05d}.warc.zst"
                    temp = f"{final}.{uuid.uuid4().hex}.tmp"
                    out = store.open_output_stream(temp, compression=None)
                    head = dictionary_frame(dictionary)
                    out.write(head)
                    records, size = 0, len(head)
                pid, to = (None if x is None else int(x) for x in (page_id, first))
                frame = packer.compress(record("response" if lone or pid == to else "revisit", pid,
                                               html.encode("utf-8", "surrogatepass"), to, url))
                out.write(frame)
                records, size = records + 1, size + len(frame)
                if size >= archive_bytes:
                    close()
        close()
        yield pd.DataFrame(listed, columns=["path", "records", "bytes"])

    store, base = _open_fs(folder)
    store.create_dir(base, recursive=True)
    ids = [F.col(c).cast("string").alias(c) for c in ("page_id", "first")]  # pandas has no null among integers
    marked.select(ids[0], "html", "url", ids[1], "lone").mapInPandas(write, "path string, records long, bytes long").write.parquet(f"{folder}/archives")
    return marked.sparkSession.read.parquet(f"{folder}/archives")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """One row per record of the listed archives, from the archives alone; each archive must hold as
    many records as the list says."""
    @lean
    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = _open_fs(folder)
        number = lambda uri: int(uri[10:-1]) if uri[10:-1] else None  # noqa: E731  <urn:page:N>
        for p in parts:
            for path, records in zip(p["path"], p["records"]):
                rows, seen = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for headers, block in read_records(stream):
                        payload = block.partition(b"\r\n\r\n")[2]
                        kind, full = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = len(payload) if kind == "response" else int(headers["WARC-Payload-Length"])
                        to = number(headers["WARC-Refers-To"]) if kind == "revisit" else None
                        rows.append((number(headers["WARC-Record-ID"]), size, full, kind, to, headers["WARC-Target-URI"]))
                        seen += 1
                        if len(rows) == 5_000:
                            yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)
                            rows = []
                if seen != records:
                    raise WarcError(f"{path} has {seen} records, not {records}")
                if rows:
                    yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)

    # one archive a task, as near as a plain split gets
    return archives.repartition(max(1, min(archives.count(), 20_000))).mapInPandas(read, SCHEMA)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = scratch_dir(spark, "warc")
    archives = write_archives(mark_revisits(pages), folder, train_dictionary(pages))
    return read_archives(archives, folder).select(*COLUMNS[:5])


OP3_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(h, (j // 4) * 5 + 1, 5))::INT >> (15 - 5 * (j % 4))::INT) & 31) + 1), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM q
"""
