"""WARC archives: one gzip member per record, written by tasks and read back in splits.

Writing marks copies first. Of the pages with equal payloads of ``REVISIT_BYTES`` bytes or
more, equal by SHA-1, the one with the largest id is a response and the others are
revisits that refer to it and hold no payload. Only digests with more than one page
are joined to the pages.

Reading is splittable. A task gets a byte range of a file, looks for the gzip magic in
it and takes a place for the start of a record only if what decompresses there begins
like a WARC header; it then owns that record, and reads on behind the end of its range
to finish it. A record that starts in front of the range belongs to another task. Each
record is decoded by exactly one task, however the ranges are cut. (A compressor that
stores an archive inside an archive uncompressed could show a false start; HTML in
UTF-8, which cannot contain the magic, has none.)

Files appear when they are complete. A manifest, written by Spark, lists those of the
attempts that were committed; left-overs of lost tasks are never read.

Defined cases: a null html is an empty payload. A null id is the smallest one, makes the
record id ``<urn:page:>`` and is read back as null. Of rows that share the largest id and
the payload, all are responses. A null url leaves the target out. A table without
rows makes a manifest without files. Other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import NativeFile
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.checks import at_least
from wordloom.llm.shipping import send_code
from wordloom.llm.storage import Output, opened
from wordloom.sources.scratch import written

REVISIT_BYTES = 1000
FILE_BYTES = 1 << 30
SPLIT_BYTES = 128 << 20
READ_BYTES = 1 << 18
DATE = "1970-01-01T00:00:00Z"

# Names and forms of the WARC and gzip formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def marked(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """``(page_id, url, payload, digest, response_id)``; the last is null for responses."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    read = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    groups = (
        read.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("largest").isNotNull())
    )
    groups = written(groups.select("digest", "largest"), "warc-copies")
    other = ~F.col("page_id").eqNullSafe(F.col("largest"))
    return read.join(groups, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(other, F.col("largest")).alias("response_id")
    )


def record(
    page_id: object, url: str | None, payload: bytes, digest: str, response_id: object, date: str
) -> bytes:
    """One WARC record, not compressed."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if response_id is None else http
    name = "" if page_id is None else page_id
    fields = [
        ("WARC-Type", "response" if response_id is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if response_id is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{response_id}>"), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Length", len(block)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + END


def write_warc(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    file_bytes: int = FILE_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write an archive of ``pages`` and return its manifest, ``(path, length, records)``.

    A task begins a new file when its last one has ``file_bytes`` bytes.
    """
    spark = pages.sparkSession
    send_code(spark)
    at_least("file_bytes", file_bytes, 1)
    data = f"{folder}/data"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, records, part = None, 0, TaskContext.get().partitionId()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out, records = Output(data, f"part-{part:05d}", ".warc.gz"), 0
                pack = zlib.compressobj(wbits=31)
                out.write(pack.compress(record(*row, date)) + pack.flush())
                records += 1
                if out.size >= file_bytes:
                    yield _closed(out, records)
                    out = None
        if out is not None:
            yield _closed(out, records)

    rows = marked(pages, page_id, url, html).mapInArrow(
        write, "path string, length bigint, records bigint"
    )
    manifest = f"{folder}/manifest"
    rows.write.mode("errorifexists").parquet(manifest)
    return spark.read.schema(rows.schema).parquet(manifest)


def _closed(out: Output, records: int) -> pa.RecordBatch:
    out.close()
    return pa.RecordBatch.from_pydict(
        {"path": [out.uri], "length": [out.size], "records": [records]}
    )


def _member(file: NativeFile, at: int, size: int) -> tuple[bytes, int] | None:
    """The record whose gzip member begins at ``at`` and where it ends, or None."""
    unpack = zlib.decompressobj(wbits=31)
    found, read = b"", at
    try:
        while len(found) < len(VERSION) and read < size:
            some = file.read_at(READ_BYTES, read)
            read += len(some)
            found += unpack.decompress(some)
        if not found.startswith(VERSION):
            return None
        parts = [found]
        while not unpack.eof:
            if read >= size:
                return None
            some = file.read_at(READ_BYTES, read)
            read += len(some)
            parts.append(unpack.decompress(some))
    except zlib.error:
        return None
    return b"".join(parts), read - len(unpack.unused_data)


def members(file: NativeFile, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """``(offset, record)`` of the records of ``file`` that begin in ``[start, stop)``."""
    size = file.size()
    at = start
    while at < stop:
        some = file.read_at(min(READ_BYTES, stop - at) + len(MAGIC) - 1, at)
        step = some.find(MAGIC)
        if step < 0:
            at += max(1, len(some) - len(MAGIC) + 1)
            continue
        at += step
        found = _member(file, at, size)
        if found is None:
            at += 1
        else:
            yield at, found[0]
            at = found[1]


def parsed(raw: bytes) -> dict[str, object]:
    """The fields of a record that archives of web pages have."""
    head, _, block = raw.partition(END)
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = block[: int(fields["content-length"])]
    http, _, payload = block.partition(END)
    kind = fields["warc-type"]
    digest = fields.get("warc-payload-digest", "").partition(":")[2]
    size: int | None = len(payload)
    if kind == "revisit":
        size = None
        for line in http.decode("latin-1").split("\r\n"):
            name, _, value = line.partition(":")
            if name.strip().lower() == "content-length":
                size = int(value)
        payload = None
    else:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return {
        "record_id": fields.get("warc-record-id"),
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_bytes": size,
        "payload_digest": base64.b32decode(digest).hex() if digest else None,
        "payload": payload,
    }


RECORD = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, "
    "payload_bytes bigint, payload_digest string, payload binary"
)


def read_warc(
    files: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True
) -> DataFrame:
    """The records of gzip-compressed archives, from ``(path, length)``.

    ``files`` is a manifest, or :func:`wordloom.llm.storage.listed` for other archives.
    Digest and size are computed from the payload; those of a revisit are what it
    says of the payload it stands for. Without ``payloads`` that column is null.
    """
    send_code(files.sparkSession)
    at_least("split_bytes", split_bytes, 1)
    ranges = files.where(F.col("length") > 0).select(
        "path",
        "length",
        F.explode(
            F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(split_bytes).cast("bigint"))
        ).alias("start"),
    )
    splits = files.agg(F.sum(F.ceil(F.col("length") / split_bytes)).alias("n")).first()["n"]
    # A number, or adaptive execution would merge these few small rows into one task.
    dealt = ranges.repartition(max(1, int(splits or 0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD.split(", ")]
        for batch in batches:
            for path, length, start in zip(*(c.to_pylist() for c in batch.columns)):
                store, name = opened(path)
                with store.open_input_file(name) as file:
                    rows: list[dict] = []
                    held = 0
                    for _, raw in members(file, start, min(length, start + split_bytes)):
                        row = parsed(raw)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held > 8 << 20:
                            yield _batch(rows, names)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, names)

    return dealt.mapInArrow(read, RECORD)


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names
    )


def page_of(urn: str) -> Column:
    """The page id inside ``<urn:page:ID>`` as text, null for none."""
    found = F.regexp_extract(urn, "^<urn:page:(.*)>$", 1)
    return F.when(found != "", found)
