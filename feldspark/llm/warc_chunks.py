"""WARC archives by way of a chunked record table.

A payload is streamed as rows (record, chunk number, bytes, digest so far): no step holds more
than one chunk of an oversized payload besides the row it came in. Each chunk becomes one WARC
record: the first is the response, further ones are continuation records with segment numbers, as
the format provides for payloads over ``chunk_bytes``. A page whose payload (of at least
``min_bytes``) another page with a smaller id holds as well becomes a revisit record without
payload.

Archives are written by Spark as gzip-compressed files of records ended by two line ends, so any
file system of Spark's can hold them; a file holds at most about ``file_bytes`` of records before
compression. The reader gets the compressed bytes of a file at once, which that limit bounds, and
inflates and parses them piece by piece. It gives back the chunk table, and digests chunks in order,
carrying the running digest from chunk to chunk. Single-chunk records never leave the task that reads them.

A null payload is empty; a null url is written as ``about:blank``. Rows that repeat a page_id with
the same payload are all responses (none has a smaller id). Rows without a page_id are revisits of
equal payloads of pages with one, else responses.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feldspark.session import materialize

CHUNK_BYTES = 4 << 20
MIN_BYTES = 100
READ_BYTES = 1 << 20
FILE_BYTES = 256 << 20
# fixed values of the format
END = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
CHUNKS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "chunk int, last boolean, data binary, running string"
)


def classify(pages: DataFrame, min_bytes: int = MIN_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to."""
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload.cast("binary"), 256).alias("payload_digest"),
    )
    first = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.min("page_id").alias("first")).where("first IS NOT NULL")
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    # a hot digest makes one partition of the left side large; Spark splits it, the right side has one row for it
    return rows.join(first, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"),
    )


def chunk_table(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows of ``CHUNKS`` for classified pages: one row for a revisit, else one per chunk of payload."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = batch.select(["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]).to_pylist()
            payloads = batch.column(batch.schema.get_field_index("payload")).cast(pa.large_binary())
            out, size = [], 0
            for row, payload in zip(rows, payloads):
                for chunk, last, data, running in chunks(b"" if row["record_type"] == "revisit" else memoryview(payload.as_buffer()), chunk_bytes):
                    out.append({**row, "chunk": chunk, "last": last, "data": bytes(data), "running": running})
                    size += len(data)
                    if size > READ_BYTES * 8:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = chunk_schema()
    return records.mapInArrow(run, CHUNKS)


def chunk_schema() -> pa.Schema:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.binary(), pa.string())
    return pa.schema([(c.split()[0], k) for c, k in zip(CHUNKS.split(", "), kinds)])


def chunks(data: memoryview | bytes, size: int) -> Iterator[tuple[int, bool, memoryview, str]]:
    """(number, last, bytes, digest of all bytes so far) of a payload, cut where a character starts."""
    digest, at, number = hashlib.sha256(), 0, 0
    while True:
        end = min(at + size, len(data))
        while at < end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        piece = data[at:end]
        digest.update(piece)
        yield number, end == len(data), piece, digest.hexdigest()
        if end == len(data):
            return
        at, number = end, number + 1


def record(row: dict, total: int) -> bytes:
    """One WARC record without its closing line ends."""
    name = "none" if row["page_id"] is None else row["page_id"]
    own = f"<urn:page:{name}:{row['chunk']}>"
    first = row["chunk"] == 0
    head = [
        "WARC/1.1", f"WARC-Type: {row['record_type'] if first else 'continuation'}", f"WARC-Record-ID: {own}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {clean(row['url'])}", f"WARC-Payload-Digest: sha256:{row['payload_digest']}", f"X-Payload-Length: {row['payload_bytes']}",
        f"X-Running-Digest: sha256:{row['running']}",
    ]
    if row["record_type"] == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{row['refers_to']}:0>", f"WARC-Profile: {PROFILE}"]
    if not (first and row["last"]):
        head.append(f"WARC-Segment-Number: {row['chunk'] + 1}")
        if not first:
            head.append(f"WARC-Segment-Origin-ID: <urn:page:{name}:0>")
        if row["last"]:
            head.append(f"WARC-Segment-Total-Length: {len(HTTP) + total}")
    block = (HTTP if first else b"") + row["data"]
    if first:
        head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + END + block


def clean(url: str | None) -> str:
    """A url that fits in a header line."""
    return "".join(c if c.isprintable() and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in url) if url else "about:blank"


def write_archives(table: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Write a chunk table as WARC files to the new folder ``path``.

    Records are gathered to lines of about ``chunk_bytes``, so a limit on the lines of a file limits its bytes.
    """

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in source:
            for row in batch.to_pylist():
                held.append(record(row, row["payload_bytes"]))
                size += len(held[-1])
                if size >= chunk_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([END.join(held).decode()], pa.string())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([END.join(held).decode()], pa.string())], ["value"])

    lines = table.mapInArrow(run, "value string").write.option("lineSep", END.decode()).option("compression", "gzip")
    lines.option("maxRecordsPerFile", max(1, file_bytes // (2 * chunk_bytes))).text(path)


class Stream:
    """Inflates a file piece by piece."""

    def __init__(self, data: bytes):
        self.data, self.at, self.held = memoryview(data), 0, bytearray()
        self.tool = zlib.decompressobj(31)

    def more(self) -> bool:
        while True:
            if self.tool.eof:
                rest = self.tool.unused_data
                if not rest and self.at >= len(self.data):
                    return False
                self.tool = zlib.decompressobj(31)
                got = self.tool.decompress(rest, READ_BYTES)
            elif self.tool.unconsumed_tail:
                got = self.tool.decompress(self.tool.unconsumed_tail, READ_BYTES)
            elif self.at < len(self.data):
                piece = self.data[self.at : self.at + READ_BYTES]
                self.at += len(piece)
                got = self.tool.decompress(piece, READ_BYTES)
            else:
                return False
            if got:
                self.held += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to the mark, which is taken as well; None at the end of the file."""
        start = 0
        while (i := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self.more():
                if self.held.strip():
                    raise ValueError("an archive ends within a record")
                return None
        out = bytes(self.held[:i])
        del self.held[: i + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("an archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def parse(data: bytes) -> Iterator[dict]:
    """The chunk rows of one archive."""
    stream = Stream(data)
    while (head := stream.until(END)) is not None:
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        block = stream.take(int(fields["Content-Length"]))
        if stream.take(len(END)) != END:
            raise ValueError("a record does not end where its length says")
        name, chunk = fields["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">").rsplit(":", 1)
        refers = fields.get("WARC-Refers-To")
        first = chunk == "0"
        yield {
            "page_id": None if name == "none" else int(name), "url": fields["WARC-Target-URI"],
            "record_type": fields["WARC-Type"], "refers_to": int(refers.split(":")[2]) if refers else None,
            "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
            "chunk": int(chunk), "last": "WARC-Segment-Number" not in fields or "WARC-Segment-Total-Length" in fields,
            "data": block[len(HTTP) :] if first else block, "running": fields["X-Running-Digest"].removeprefix("sha256:"),
        }


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of all records of the archives in ``path``."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for value in batch.column(0):
                out, size = [], 0
                for row in parse(value.as_buffer()):
                    out.append(row)
                    size += len(row["data"]) + 200
                    if size > READ_BYTES * 8:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    schema = chunk_schema()
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, CHUNKS)


def payload_index(table: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to as read: bytes and digest of the payload itself.

    Revisits have those of the payload they refer to, from their headers.
    """

    def single(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a record of one chunk is settled here; others go on with their data
        for batch in source:
            rows = batch.to_pylist()
            for row in rows:
                if row["chunk"] == 0 and row["last"]:
                    digest = hashlib.sha256(row["data"]).hexdigest()
                    if digest != row["running"]:
                        raise ValueError(f"the payload of page {row['page_id']} is damaged")
                    if row["record_type"] == "response":
                        row["payload_digest"], row["payload_bytes"] = digest, len(row["data"])
                    row["data"] = None
            yield pa.RecordBatch.from_pylist(rows, schema)

    def carry(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # chunks of a payload follow each other; only the running digest is kept between them
        running, size, copies = None, 0, 1
        for batch in source:
            out = []
            for row in batch.to_pylist():
                if row["chunk"] == 0:
                    running, size, copies = hashlib.sha256(), 0, row["copies"]
                running.update(row["data"])
                size += len(row["data"])
                if running.hexdigest() != row["running"]:
                    raise ValueError(f"chunk {row['chunk']} of page {row['page_id']} is damaged")
                if row["last"]:
                    done = {"page_id": row["page_id"], "payload_bytes": size, "payload_digest": running.hexdigest(), "record_type": "response"}
                    out += [done] * copies
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([(n, schema.field(n).type) for n in names]))

    schema = chunk_schema()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    read = materialize(table.mapInArrow(single, CHUNKS), "records")
    # rows that repeat a page have the same chunks; they are digested once and counted
    parts = read.where("data IS NOT NULL").groupBy("page_id", "payload_digest", "chunk").agg(
        F.first("last").alias("last"), F.first("data").alias("data"), F.first("running").alias("running"), F.count("*").alias("copies")
    )
    parts = parts.repartition("page_id", "payload_digest").sortWithinPartitions("page_id", "payload_digest", "chunk")
    long = parts.mapInArrow(carry, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return read.where("data IS NULL").select(*names).unionByName(long)
