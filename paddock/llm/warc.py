"""WARC archives whose records are compressed one by one with a shared Zstandard dictionary.

The dictionary is built from a bounded sample of the pages and stands, in a skippable frame, at
the head of every file; each record is a frame of its own, so a reader can start at any record.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, stage, table
from .sharedfs import AtomicWriter, read_bytes

#: Fixed values of the format: the skippable frame that holds a dictionary, and a frame's magic.
DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

MIN_REVISIT_BYTES = 100
SAMPLE_RECORDS = 1_000
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536
FILE_BYTES = 1 << 30
LEVEL = 3


def decide(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, payload_digest, refers_to (null: a response).

    Of equal payloads of at least ``min_revisit_bytes``, the row with the smallest id is the
    response. Null html is an empty payload. Null ids are never referred to; rows that repeat
    the response's id are responses too."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    long = rows.where(F.octet_length("payload") >= min_revisit_bytes).select("page_id", "payload_digest")
    first = long.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    joined = rows.join(first, "payload_digest", "left")
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to"))


def build_dictionary(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", records: int = SAMPLE_RECORDS, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from at most ``records`` pages, the first SAMPLE_BYTES characters of each (a
    model of the data, no data: every record is archived whole). Where the pages are too few or too alike
    to train one, their own text is the dictionary; pages without text give none."""
    import zstandard

    order = F.xxhash64(F.col(id_col))
    last = pages.select(order.alias("o")).orderBy("o").limit(records).agg(F.max("o")).first()[0]  # page ids alone are read
    if last is None:
        return b""
    sample = pages.where(order <= last).select(F.substring(F.col(html_col).cast("string"), 1, SAMPLE_BYTES).alias("h")).where("h <> ''").limit(records)
    texts = sorted(r[0].encode() for r in sample.collect())
    try:
        return zstandard.train_dictionary(size, texts, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(texts)[-size:]


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(decided: DataFrame, folder: str, dictionary: bytes, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one file or more for each partition; return the manifest (path, n_records)."""

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        task = TaskContext.get()
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        rows = (r for b in batches for r in zip(*(b.column(i) for i in range(5)), strict=True))
        n, row = 0, next(rows, None)
        while row is not None:
            path = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}-{n:03d}.warc.zst"
            count = size = 0
            with AtomicWriter(path) as out:
                out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                while row is not None and size < file_bytes:
                    page_id, url, payload, digest, refers_to = (x.as_py() for x in row)
                    size += out.write(packer.compress(record(page_id, url, payload.encode(), digest, refers_to)))
                    count += 1
                    row = next(rows, None)
            n += 1
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [count]})

    return decided.mapInArrow(write, "path string, n_records long")


def frames(data) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of each frame after the dictionary."""
    import zstandard

    magic, n = struct.unpack("<II", data[:8])
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the head")
    known = zstandard.ZstdCompressionDict(data[8 : 8 + n]) if n else None
    unpacker = zstandard.ZstdDecompressor(dict_data=known)
    at, view = 8 + n, memoryview(data)
    while at < len(view):
        one = unpacker.decompressobj()
        text, step = [], 1 << 16
        start = at
        while not one.eof:
            piece = view[at : at + step]
            if not len(piece):
                raise ValueError("a record is cut off")
            text.append(one.decompress(piece))
            at += len(piece)
        at -= len(one.unused_data)
        yield start, b"".join(text)


def parse(raw: bytes) -> dict:
    """Fields of a record; a response's payload is measured and hashed anew."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    n = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload and header differ in {fields['WARC-Record-ID']}")
    number = lambda k: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(k, ""))) else None
    return {"page_id": number("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "payload_bytes": n, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"), "payload": payload}


FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, path string, at long"


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the files in ``manifest`` (column path), checked against its digest."""
    names = [x.split()[0] for x in FIELDS.split(", ")]

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("path", pa.string()), ("at", pa.int64())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for at, raw in frames(read_bytes(path)):
                    rows.append(parse(raw) | {"path": path, "at": at})
                    del rows[-1]["payload"]
                    if len(rows) == 5_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    n = max(1, manifest.count())
    return manifest.select("path").repartition(min(n, 10_000)).mapInArrow(read, FIELDS).select(*names)


def archive(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages to ``folder`` (a new shared one unless given) and return the manifest. No
    pages give no files."""
    folder = folder or shared_dir(pages.sparkSession, "warc")
    return stage(write_archives(decide(pages, id_col, url_col, html_col), folder, build_dictionary(pages, id_col, html_col)), "warc-manifest")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, written to archives and read back."""
    return read_archives(archive(table(spark, sf_dir, "pages"))).drop("path", "at")


SQL = """
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> m THEN m END AS refers_to
FROM (SELECT page_id, n, d, min(page_id) OVER (PARTITION BY h) AS m
      FROM (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS d FROM pages))
"""
