"""WARC archives: write them, and turn whole-file gzip into one member for each record.

An archive that is one gzip stream can only be read from its start. The normaliser
inflates such a stream once, writes every record again as a gzip member of its
own, and beside the archive an index of offsets, with which one record can be
read alone. One task takes one archive, and holds one record at a time.

Archives lie in a folder given as a URI that pyarrow can open on every executor
(file, hdfs, s3, gs, abfss; a shared mount counts as file). A task writes under a
name of its own and renames when done, so a task that runs twice leaves one archive.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.llm.common import ROW, TAG, Scratch, table, tagged_rows, utf8

REVISIT_FROM_BYTES = 100
CHUNK = 1 << 20
INDEX_SUFFIX = ".index.jsonl"
_GZIP = 16 + zlib.MAX_WBITS


# files -------------------------------------------------------------------------


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it; Hadoop's names for S3 are understood."""
    for scheme in ("s3a://", "s3n://"):
        if uri.startswith(scheme):
            uri = "s3://" + uri[len(scheme) :]
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def _written(fs: pafs.FileSystem, path: str, write: Callable[[BinaryIO], None]) -> None:
    """Write under a name of this attempt, then put the file in its place."""
    own = f"{path}.{uuid.uuid4().hex[:12]}.part"
    try:
        with fs.open_output_stream(own, compression=None) as out:
            write(out)
        if fs.get_file_info(path).type == pafs.FileType.File:
            fs.delete_file(path)  # of an earlier attempt, with the same content; not every store moves over a file
        fs.move(own, path)
    except BaseException:
        if fs.get_file_info(own).type == pafs.FileType.File:
            fs.delete_file(own)
        raise


# records -----------------------------------------------------------------------


def format_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record with its closing blank lines. A line break in a value would end the header, and becomes a blank."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {' '.join(v.split())}" for k, v in headers)]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of a gzip stream of one member or many, piece by piece, each of bounded size."""
    stream = None
    for chunk in chunks:
        while chunk:
            stream = stream or zlib.decompressobj(_GZIP)
            out = stream.decompress(chunk, CHUNK)
            if out:
                yield out
            if stream.eof:
                chunk, stream = stream.unused_data, None
            else:
                chunk = stream.unconsumed_tail
    if stream is not None:
        raise EOFError("the archive ends within a gzip member")


def _read_chunks(source: BinaryIO) -> Iterator[bytes]:
    while chunk := source.read(CHUNK):
        yield chunk


class _Buffer:
    """Bytes of a stream, read on as far as asked."""

    def __init__(self, pieces: Iterator[bytes]):
        self._pieces, self._held = pieces, bytearray()

    def _more(self) -> bool:
        piece = next(self._pieces, None)
        if piece is None:
            return False
        self._held += piece
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the stream."""
        seen = 0
        while (at := self._held.find(mark, seen)) < 0:
            seen = max(0, len(self._held) - len(mark) + 1)
            if not self._more():
                if self._held.strip():
                    raise EOFError("the archive ends within a record's header")
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self._held) < n:
            if not self._more():
                raise EOFError("the archive ends within a record")
        out = bytes(self._held[:n])
        del self._held[:n]
        return out


def read_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(headers, block, whole record) for each record of an inflated archive; header names in lower case."""
    buffer = _Buffer(pieces)
    while (head := buffer.until(b"\r\n\r\n")) is not None:
        version, *lines = head.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}
        block = buffer.take(int(headers["content-length"]))
        yield headers, block, head + block + buffer.take(4)


# writing -----------------------------------------------------------------------


def typed_pages(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(page_id, url, _payload, refers_to, revisit): which pages repeat an earlier payload.

    Of pages with equal payloads of 100 bytes and more, the one with the smallest
    page_id (of equal ids the first row) is a response, the others revisit it. A
    NULL page_id comes last. Only digests and ids are grouped, so a payload that
    very many pages share is combined before the shuffle.
    """
    rows = tagged_rows(pages.select("page_id", "url", "html"), scratch).select(
        F.col(f"{ROW}.page_id").cast("long").alias("page_id"), f"{ROW}.url", utf8(f"{ROW}.html").alias("_payload"), TAG
    ).withColumn("_digest", F.when(F.length("_payload") >= REVISIT_FROM_BYTES, F.sha2("_payload", 256)))
    order = F.struct(F.col("page_id").isNull().alias("n"), F.col("page_id").alias("id"), F.col(TAG).alias("t"))
    repeated = (
        rows.filter(F.col("_digest").isNotNull()).groupBy("_digest")
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    )
    repeated = scratch.stage(repeated, "repeated")
    # The ids of revisits are joined to the pages, which is a small table unless most pages are revisits.
    revisits = rows.select("_digest", TAG).join(repeated, "_digest").filter(F.col(TAG) != F.col("_first.t")).select(
        TAG, F.col("_first.id").alias("refers_to"), F.lit(True).alias("revisit")
    )
    revisits = scratch.stage(revisits, "revisits")
    return rows.join(revisits, TAG, "left").select(
        "page_id", "url", "_payload", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit")
    )


def _page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    digest = hashlib.sha256(payload).hexdigest()
    name = "" if page_id is None else str(page_id)
    headers = [
        ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Target-URI", url or ""), ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "text/html; charset=utf-8"),
    ]
    if not revisit:
        return format_record("response", headers, payload)
    first = "" if refers_to is None else str(refers_to)
    headers += [
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", f"<urn:page:{first}>"), ("X-Payload-Length", str(len(payload))),
    ]
    return format_record("revisit", headers, b"")


def write_monolithic(pages: DataFrame, folder: str, scratch: Scratch) -> DataFrame:
    """Write the pages as archives of one gzip stream each, one archive for each partition.

    Returns (archive, records), which has to be evaluated for the writing to happen.
    """
    rows = typed_pages(pages, scratch)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        fs.create_dir(path, recursive=True)
        name, records = f"pages-{TaskContext.get().partitionId():06d}.warc.gz", 0

        def write(out: BinaryIO) -> None:
            nonlocal records
            stream = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out.write(stream.compress(_page_record(*row)))
                    records += 1
            out.write(stream.flush())

        _written(fs, f"{path}/{name}", write)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], ["archive", "records"])

    return rows.mapInArrow(of_batches, "archive string, records long")


# normalising -------------------------------------------------------------------


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, bytes) of the finished archives in a folder, dealt out by size."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), F.col("length").alias("bytes"))


def _normalise(source: BinaryIO, out: BinaryIO, index: list[str]) -> None:
    at = 0
    for headers, _, record in read_records(inflate(_read_chunks(source))):
        stream = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
        member = stream.compress(record) + stream.flush()
        out.write(member)
        entry = {"offset": at, "length": len(member), "type": headers.get("warc-type"), "id": headers.get("warc-record-id")}
        index.append(json.dumps(entry | {"uri": headers.get("warc-target-uri")}))
        at += len(member)


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite the archives of one folder in another, each record a gzip member, with an index beside each.

    Returns (archive, records, bytes), to be evaluated for the writing to happen.
    The index has a JSON line for each record: offset and length of its member,
    type, record id and URI. Archives whose records are members already come out
    the same way; a truncated one is an error.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(source)
        out_fs, out_path = open_folder(target)
        out_fs.create_dir(out_path, recursive=True)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                index: list[str] = []

                def write(out: BinaryIO, name: str = name, index: list[str] = index) -> None:
                    with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                        _normalise(stream, out, index)

                _written(out_fs, f"{out_path}/{name}", write)
                text = "".join(line + "\n" for line in index).encode()
                _written(out_fs, f"{out_path}/{name}{INDEX_SUFFIX}", lambda out, text=text: out.write(text))
                size = out_fs.get_file_info(f"{out_path}/{name}").size
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([len(index)], pa.int64()), pa.array([size], pa.int64())],
                    ["archive", "records", "bytes"],
                )

    return archives(spark, source).select("archive").mapInArrow(of_batches, "archive string, records long, bytes long")


# reading -----------------------------------------------------------------------

RECORD_SCHEMA = (
    "archive string, offset long, length long, record_type string, record_id string, target_uri string, "
    "payload_digest string, payload_bytes long, refers_to string, payload binary"
)


def _by_index(fs: pafs.FileSystem, path: str) -> Iterator[tuple[dict, dict[str, str], bytes]]:
    """The records of an archive, each read by its offset and inflated by itself."""
    with fs.open_input_stream(path + INDEX_SUFFIX, compression=None) as lines:
        entries = [json.loads(line) for line in lines.read().splitlines()]
    with fs.open_input_file(path) as archive:
        for entry in entries:
            member = archive.read_at(entry["length"], entry["offset"])
            headers, block, _ = next(read_records(inflate(iter([member]))))
            yield entry, headers, block


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the normalised archives, by their indexes.

    payload_digest is computed anew for records with a payload, and an error if
    it is not the one in the record's header; for revisits it is the header's.
    payload is NULL for revisits.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        schema = None
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows: list[tuple] = []
                held = 0
                for entry, headers, block in _by_index(fs, f"{path}/{name}"):
                    kind, stated = headers.get("warc-type"), headers.get("warc-payload-digest", "").removeprefix("sha256:")
                    revisit = kind == "revisit"
                    digest = stated if revisit else hashlib.sha256(block).hexdigest()
                    if stated and digest != stated:
                        raise ValueError(f"{name}: the payload of {headers.get('warc-record-id')} has another digest")
                    size = int(headers.get("x-payload-length", 0)) if revisit else len(block)
                    rows.append((
                        name, entry["offset"], entry["length"], kind, headers.get("warc-record-id"),
                        headers.get("warc-target-uri"), digest, size, headers.get("warc-refers-to"), None if revisit else block,
                    ))
                    held += len(block)
                    if len(rows) == 1000 or held > 8 * CHUNK:
                        yield _record_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _record_batch(rows)

    return archives(spark, folder).select("archive").mapInArrow(of_batches, RECORD_SCHEMA)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]
    names = [c.split(" ")[0] for c in RECORD_SCHEMA.split(", ")]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def round_trip(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """Write, normalise and read again: the records of the pages' archives (see read_archives)."""
    spark, first, second = scratch.spark, scratch.path("monolithic"), scratch.path("members")
    if not scratch.stage(write_monolithic(pages, first, scratch), "written").agg(F.sum("records")).first()[0]:
        return spark.createDataFrame([], RECORD_SCHEMA)
    scratch.stage(normalise(spark, first, second), "normalised")
    return read_archives(spark, second)


def page_number(record_id: str):
    """The page_id in a record id; NULL where there was none."""
    return F.expr(f"try_cast(nullif(regexp_extract({record_id}, '^<urn:page:(-?[0-9]*)>$', 1), '') AS BIGINT)")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = round_trip(table(spark, sf_dir, "pages"), Scratch(spark))
    return records.select(
        page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_number("refers_to").alias("refers_to"),
    )


def op6_sql() -> str:
    return (
        "WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS size, "
        "row_number() OVER (PARTITION BY html ORDER BY page_id) AS place, "
        "min(page_id) OVER (PARTITION BY html) AS first_id FROM pages), "
        f"typed AS (SELECT *, size >= {REVISIT_FROM_BYTES} AND place > 1 AS again FROM payloads) "
        "SELECT page_id, size::BIGINT AS payload_bytes, sha256(payload) AS payload_digest, "
        "CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, "
        "CASE WHEN again THEN first_id END AS refers_to FROM typed"
    )
