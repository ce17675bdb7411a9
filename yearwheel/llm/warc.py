"""WARC archives with an index: write, look up, read back by coalesced byte ranges.

``write_archives`` stores one record per page. Among records with equal payloads of at least
``revisit_bytes`` bytes, that with the largest page_id is a ``response`` and the others are
``revisit`` records that name it and hold no payload; shorter payloads are always stored. Each
record is a gzip member of its own, so its byte range can be read alone. The index (file, offset,
length, url, digest) is written first and is all a lookup needs: ``read_records`` takes any selection
of index rows, deals them out in file order and reads neighbouring ranges together.

Defined cases: a null html is an empty payload, a null url leaves the header out, a null page_id can
be nobody's reference (a group without any page_id is stored in full), rows that repeat the largest
page_id of their group are all responses, and an empty table gives an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearwheel.llm import files

INDEX = "page_id long, file string, offset long, length long, url string, digest string"
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# what may not stand in a header line, and the sign that marks what was replaced
_UNSAFE = re.compile(r"[\x00-\x20\x7f%]")


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _of_urn(text: str | None) -> int | None:
    inner = (text or "<urn:page:none>")[len("<urn:page:") : -1]
    return None if inner == "none" else int(inner)


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{b32}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: quote(m[0], safe=""), url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of :data:`RECORD` from the bytes of one record; raises ValueError if they are damaged."""
    stream = io.BytesIO(data)

    def headers(first: bytes) -> dict[str, str]:
        if not stream.readline().startswith(first):
            raise ValueError(f"record does not begin with {first!r}")
        found = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            found[key] = value
        return found

    warc = headers(b"WARC/1.1")
    begin, length = stream.tell(), int(warc["Content-Length"])
    http = headers(b"HTTP/1.1")
    payload = data[stream.tell() : begin + length]
    revisit = warc["WARC-Type"] == "revisit"
    digest = base64.b32decode(warc["WARC-Payload-Digest"].partition(":")[2]).hex()
    size = int(http["Content-Length"])
    if data[begin + length :] != b"\r\n\r\n" or len(payload) != (0 if revisit else size):
        raise ValueError("record length differs from its header")
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("payload differs from its digest")
    url = warc.get("WARC-Target-URI")
    return {
        "page_id": _of_urn(warc["WARC-Record-ID"]),
        "url": None if url is None else unquote(url),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": warc["WARC-Type"],
        "refers_to": _of_urn(warc.get("WARC-Refers-To")),
        "payload": None if revisit else payload,
    }


def with_revisits(pages: DataFrame, revisit_bytes: int = 1000) -> DataFrame:
    """Pages (page_id, url, html) with digest and, for revisits, refers_to."""
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    shared = (
        rows.where(F.octet_length("html") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("stored"))
        .where("n > 1 AND stored IS NOT NULL")
        .select("digest", "stored")
    )
    return rows.join(shared, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("stored").eqNullSafe(F.col("page_id")), F.col("stored"))
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    revisit_bytes: int = 1000,
    file_bytes: int = 1 << 30,
    level: int = 4,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write the records below ``folder`` and return their index, itself written to ``folder``/index."""

    def write(batches):
        sink = None
        for batch in batches:
            out = {name: [] for name in ("page_id", "file", "offset", "length", "url", "digest")}
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if sink is None or sink.size >= file_bytes:
                    if sink is not None:
                        sink.close()
                    sink = files.Sink(f"{folder}/warc", ".warc.gz")
                record = record_bytes(page_id, url, html.encode(), digest, refers_to, refers_to is not None, date)
                member = gzip.compress(record, level, mtime=0)
                row = (page_id, sink.path, sink.write(member), len(member), url, digest)
                for values, value in zip(out.values(), row, strict=True):
                    values.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out.values(), _INDEX_TYPES, strict=True)], names=list(out)
            )
        if sink is not None:
            sink.close()

    rows = with_revisits(pages, revisit_bytes).select("page_id", "url", "html", "digest", "refers_to")
    rows.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


_INDEX_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
_RECORD_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]


def read_records(
    index: DataFrame, payload: bool = True, task_bytes: int = 64 << 20, batch_bytes: int = 8 << 20
) -> DataFrame:
    """Records that the index rows name, each checked against its digest.

    Index rows are dealt out by range of (file, offset), about ``task_bytes`` of archive to a task.
    """
    spark: SparkSession = index.sparkSession
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    parts = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    names = [n.split()[0] for n in RECORD.split(", ")]

    def read(batches):
        def flushed(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([f[n] for f in found], t) for n, t in zip(names, _RECORD_TYPES, strict=True)], names=names
            )

        for batch in batches:
            wanted = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            found, size = [], 0
            for _, data in files.coalesced(wanted):
                record = parse_record(gzip.decompress(data))
                if not payload:
                    record["payload"] = None
                found.append(record)
                size += record["payload_bytes"]
                if size >= batch_bytes:
                    yield flushed(found)
                    found, size = [], 0
            yield flushed(found)

    dealt = index.select("file", "offset", "length").repartitionByRange(parts, "file", "offset")
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(read, RECORD)
