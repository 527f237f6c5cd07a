import gzip
import hashlib
import json
import zlib

import pytest
from pyspark.sql import functions as F

from matchledger.llm import warc
from tests.conftest import SF_DIR

PAGE = "page_id long, url string, html string, refers_to long, revisit boolean, _payload string, archive string"


def pages(spark, *rows):
    return spark.createDataFrame([(i, u, h, 1, True, "p", "a") for i, u, h in rows], PAGE).coalesce(2)


def expected(rows):
    firsts, out = {}, []
    key = lambda i: (i is None, i or 0)
    for i, _, h in sorted(rows, key=lambda r: key(r[0])):
        payload = (h or "").encode()
        digest = hashlib.sha256(payload).hexdigest()
        if len(payload) >= 100 and payload in firsts:
            out.append((i, len(payload), digest, "revisit", firsts[payload]))
        else:
            firsts[payload] = i
            out.append((i, len(payload), digest, "response", None))
    return sorted(out, key=repr)


def result(records):
    rows = records.select(
        warc.page_number("record_id").alias("i"), "payload_bytes", "payload_digest", "record_type",
        warc.page_number("refers_to").alias("r"),
    ).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_query_gives_every_page_back(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html").collect()]
    found = warc.op6_warc(spark, SF_DIR).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


def test_odd_pages(spark, scratch):
    same, near = "é" * 50, "é" * 49
    rows = [
        (5, "u", same), (3, "u", same), (3, "u", same), (None, None, same), (9, "a\r\nWARC-Type: x", near), (8, "u", near),
        (7, "", None), (6, "", ""), (1, "u", "WARC/1.1\r\n\r\n" * 40), (2, "u", "long " * 400_000), (-4, "u", "\r\n\r\n"),
    ]
    records = warc.round_trip(pages(spark, *rows), scratch)
    assert result(records) == expected(rows)
    by_id = {r.record_id: r for r in records.collect() if r.record_type == "response"}
    assert by_id["<urn:page:2>"].payload.decode() == "long " * 400_000
    assert by_id["<urn:page:9>"].target_uri == "a WARC-Type: x"


def test_only_nulls_share_a_payload(spark, scratch):
    rows = [(None, "u", "x" * 100), (None, "u", "x" * 100)]
    found = result(warc.round_trip(pages(spark, *rows), scratch))
    assert sorted(f[3] for f in found) == ["response", "revisit"]


def test_empty_table(spark, scratch):
    assert warc.round_trip(pages(spark, (1, "u", "h")).limit(0), scratch).count() == 0


def test_members_stand_where_the_index_says(spark, scratch):
    df = pages(spark, *[(i, f"http://x/{i}", f"<p>{i}</p>" * 30) for i in range(20)])
    first, second = scratch.path("first"), scratch.path("second")
    assert warc.write_monolithic(df, first, scratch).agg(F.sum("records")).first()[0] == 20
    done = {r.archive: r for r in warc.normalise(spark, first, second).collect()}
    one, two = (warc.open_folder(f)[1] for f in (first, second))
    for name, row in done.items():
        whole, parted = open(f"{one}/{name}", "rb").read(), open(f"{two}/{name}", "rb").read()
        assert len(parted) == row.bytes
        assert gzip.decompress(whole) == gzip.decompress(parted)
        stream = zlib.decompressobj(31)
        stream.decompress(whole)
        assert stream.eof and not stream.unused_data  # one stream before
        entries = [json.loads(x) for x in open(f"{two}/{name}{warc.INDEX_SUFFIX}")]
        assert len(entries) == row.records
        at = 0
        for e in entries:
            assert e["offset"] == at
            record = gzip.decompress(parted[at : at + e["length"]])
            assert record.startswith(b"WARC/1.1\r\nWARC-Type: response") and record.endswith(b"\r\n\r\n")
            assert e["uri"].encode() in record
            at += e["length"]
        assert at == len(parted)

    # A second pass over members changes nothing.
    third = scratch.path("third")
    assert warc.normalise(spark, second, third).agg(F.sum("records")).first()[0] == 20
    path = warc.open_folder(third)[1]
    assert all(open(f"{path}/{n}", "rb").read() == open(f"{two}/{n}", "rb").read() for n in done)


def test_a_truncated_archive_is_an_error():
    record = warc.format_record("response", [("A", "b")], b"payload" * 1_000)
    whole = gzip.compress(record)
    assert [b for _, b, _ in warc.read_records(warc.inflate(iter([whole[:50], whole[50:]])))] == [b"payload" * 1_000]
    with pytest.raises(EOFError):
        list(warc.read_records(warc.inflate(iter([whole[:-20]]))))
    with pytest.raises(EOFError):
        list(warc.read_records(iter([record[:-2]])))
    with pytest.raises(ValueError, match="not a WARC"):
        list(warc.read_records(iter([b"HTTP/1.1 200\r\n\r\n"])))


def test_inflated_pieces_are_small():
    stream = gzip.compress(b"0" * 50_000_000)
    assert max(map(len, warc.inflate(iter([stream])))) <= warc.CHUNK


def test_uris():
    assert warc.open_folder("file:///tmp/x")[1] == "/tmp/x"
    assert warc.open_folder("file:/tmp/x")[1] == "/tmp/x"
