import hashlib
import io
import base64

import pytest
import zstandard

from layerflow.llm import warc
from layerflow.session import scratch_dir


def archive(records, dictionary=b""):
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    return warc.dictionary_frame(dictionary) + b"".join(packer.compress(r) for r in records)


def rec(i, payload=b"hello", kind="response", to=None):
    return warc.record(kind, i, payload, to, f"http://h/{i}")


def test_reader_validates():
    data = archive([rec(1), rec(2, b"", "revisit", 1), rec(3, b"x" * 3_000_000)])
    got = list(warc.read_records(io.BytesIO(data)))
    assert [h["WARC-Record-ID"] for h, _ in got] == ["<urn:page:1>", "<urn:page:2>", "<urn:page:3>"]
    bad = [data[:-3], data[:5], b"\0" * 40, data[:40], archive([rec(1) + rec(2)]), archive([rec(1)[:-4]]),
           archive([rec(1).replace(b"hello", b"hellO")]), archive([rec(1).replace(b"WARC/1.1", b"HTTP/1.1")]),
           archive([rec(1).replace(b"WARC-Date", b"X-Date")]), archive([rec(1).replace(b"Content-Length: ", b"Content-Length: 9")])]
    for b in bad:
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(b)))


def test_round_trip_of_odd_pages(spark):
    html = ["<p>a</p>", None, "", "é\r\n\r\n\0x", "z" * 2_000_000, "<p>a</p>", "<p>a</p>", None]
    rows = [(2**60 + i, f"http://h/{i}\n x", h, "sha", 1) for i, h in enumerate(html)] + [(None, None, "<p>a</p>", None, 2), (None, None, "q", None, 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, sha string, first int").repartition(3)
    folder = scratch_dir(spark, "warctest")
    listed = warc.write_archives(warc.mark_revisits(df), folder, warc.train_dictionary(df), archive_bytes=500)
    out = {r["page_id"]: r for r in warc.read_archives(listed, folder).where("page_id IS NOT NULL").collect()}
    firsts = {}
    for i, _, h, *_ in rows:
        if i is not None:
            firsts.setdefault((h or "").encode(), i)
    for i, _, h, *_ in rows:
        if i is None:
            continue
        b = (h or "").encode()
        r = out[i]
        assert r["payload_bytes"] == len(b) and r["payload_digest"] == base64.b32encode(hashlib.sha1(b).digest()).decode()
        assert r["record_type"] == ("response" if firsts[b] == i else "revisit")
        assert r["refers_to"] == (None if firsts[b] == i else firsts[b])
    both = warc.read_archives(listed, folder).where("page_id IS NULL").orderBy("record_type").collect()
    assert [r["record_type"] for r in both] == ["response", "revisit"] and both[1]["refers_to"] == 2**60
    assert sum(r["records"] for r in listed.collect()) == len(rows)


def test_min_bytes_and_no_pages(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")],
                               "page_id long, url string, html string")
    marked = {r["page_id"]: r["first"] for r in warc.mark_revisits(df, min_bytes=5).collect()}
    assert marked == {1: None, 2: None, 3: 3, 4: 3}
    folder = scratch_dir(spark, "warctest")
    listed = warc.write_archives(warc.mark_revisits(df.limit(0)), folder, warc.train_dictionary(df.limit(0)))
    assert warc.read_archives(listed, folder).count() == 0
