"""WARC archives written and read as a table of record chunks.

Method. A page becomes rows (record id, chunk number, chunk): a payload above CHUNK_BYTES is never
one value but a sequence of rows, written as the segments that the format has for this
(`continuation` records). Rows are written by Spark's text writer, which passes bytes through
unchanged, with the line end that closes a record, as gzip files. Reading streams over a file's
lines with a state machine that follows Content-Length. It emits chunk rows again, each with the
payload's bytes so far and the SHA-256 so far, so the last row of a record carries the digest of
the whole payload and no record is ever in memory as a whole.

Records with equal payloads of at least MIN_REVISIT_BYTES are written once: the smallest page_id
is the response, the others revisit it.

Defined cases: a NULL payload is empty. A NULL page_id sorts after all others and is an empty id in
the archive. Rows that repeat a page_id are records of their own; if they share the smallest id of
equal payloads, each is a response. Line ends in a url are percent-encoded, a NULL url has no
header. Extra columns are ignored. A file that ends inside a record gives the rows read so far
without a last one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit

from tripspark.llm.common import new_path, rows

CHUNK_BYTES = 1 << 20
MIN_REVISIT_BYTES = 100
EOL = "\r\n"
ID_PREFIX = "urn:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload (binary), payload_bytes, payload_digest and refers_to (NULL for
    responses)."""
    payload = F.coalesce("html", lit("")).cast("binary")
    digested = pages.select(
        col("page_id").cast("long").alias("page_id"),
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    # Groups of equal payloads are reduced before any payload moves; usually few remain.
    first = (
        digested.where(col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1 AND first_id IS NOT NULL")
        .select("payload_digest", "first_id")
    )
    refers = F.when(~col("page_id").eqNullSafe(col("first_id")), col("first_id"))
    return digested.join(first, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest", refers.alias("refers_to")
    )


def chunks(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk: chunk_no from 0, n_chunks, chunk. Revisits have one empty chunk."""
    n = F.when(col("refers_to").isNotNull(), lit(1)).otherwise(
        F.greatest(F.ceil(col("payload_bytes") / chunk_bytes), lit(1))
    )
    part = F.substring(
        col("payload"), col("chunk_no") * lit(chunk_bytes) + 1, lit(chunk_bytes)
    )
    return (
        records.withColumn("n_chunks", n.cast("int"))
        .withColumn("chunk_no", F.explode(F.sequence(lit(0), col("n_chunks") - 1)))
        .withColumn(
            "chunk", F.when(col("refers_to").isNull(), part).otherwise(lit(b""))
        )
        .drop("payload")
    )


def _record(date: str) -> Column:
    """A chunk row as the text of a WARC record, without its last line end."""
    page = F.coalesce(col("page_id").cast("string"), lit(""))
    own = F.concat(lit("<" + ID_PREFIX), page, lit(">"))
    first, revisit = col("chunk_no") == 0, col("refers_to").isNotNull()
    split, last = col("n_chunks") > 1, col("chunk_no") == col("n_chunks") - 1

    def line(name: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(lit(name + ": "), value, lit(EOL))
        return text if when is None else F.when(when, text).otherwise(lit(""))

    http = F.when(
        first & ~revisit,
        F.concat(
            lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
            col("payload_bytes").cast("string"),
            lit(EOL + EOL),
        ),
    ).otherwise(lit(""))
    http_bytes = F.octet_length(http)
    first_http = (
        F.octet_length(col("payload_bytes").cast("string"))
        + len(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: ")
        + 4
    )
    kind = F.when(~first, "continuation").when(revisit, "revisit").otherwise("response")
    part = F.concat(
        lit("<" + ID_PREFIX), page, lit("#"), col("chunk_no").cast("string"), lit(">")
    )
    url = F.replace(F.replace(col("url"), lit("\r"), lit("%0D")), lit("\n"), lit("%0A"))
    head = F.concat(
        lit("WARC/1.0" + EOL),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.when(first, own).otherwise(part)),
        line("WARC-Date", lit(date)),
        line("WARC-Target-URI", url, first & url.isNotNull()),
        line("WARC-Payload-Digest", F.concat(lit("sha256:"), col("payload_digest")), first),
        line("X-Payload-Length", col("payload_bytes").cast("string"), revisit),
        line(
            "WARC-Refers-To",
            F.concat(lit("<" + ID_PREFIX), col("refers_to").cast("string"), lit(">")),
            revisit,
        ),
        line("WARC-Profile", lit(REVISIT_PROFILE), revisit),
        line("WARC-Segment-Origin-ID", own, ~first),
        line("WARC-Segment-Number", (col("chunk_no") + 1).cast("string"), split),
        line(
            "WARC-Segment-Total-Length",
            (col("payload_bytes") + first_http).cast("string"),
            split & last,
        ),
        line("Content-Type", lit("application/http;msgtype=response"), first & ~revisit),
        line("Content-Length", (F.octet_length("chunk") + http_bytes).cast("string")),
        lit(EOL),
    )
    # A string of these bytes: Spark neither checks nor changes them, the writer copies them.
    return F.concat(head, http, col("chunk").cast("string"), lit(EOL)).alias("value")


def write_archive(
    records: DataFrame,
    path: str,
    chunk_bytes: int = CHUNK_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write the records of `with_revisits` as gzip WARC files, one per partition. The rows of a
    record stay together and in order, since they come from one row."""
    (
        chunks(records, chunk_bytes)
        .select(_record(date))
        .write.option("lineSep", EOL)
        .option("compression", "gzip")
        .text(path)
    )


_CHUNKS = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.string()),
        ("url", pa.string()),
        ("chunk_no", pa.int32()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("last", pa.bool_()),
        ("chunk", pa.binary()),
    ]
)
_CHUNKS_DDL = (
    "record_id string, record_type string, refers_to string, url string, chunk_no int, "
    "payload_bytes long, payload_digest string, last boolean, chunk binary"
)


class _Reader:
    """Follows the lines of one file; `out` collects chunk rows."""

    def __init__(self, chunk_bytes: int, with_chunks: bool):
        self.chunk_bytes, self.with_chunks = chunk_bytes, with_chunks
        self.out: list[tuple] = []
        self.restart()

    def restart(self) -> None:
        self.state, self.headers, self.left, self.owed = "between", {}, 0, False
        self.origin: tuple | None = None

    def line(self, data: bytes) -> None:
        """One line without its line end."""
        if self.owed:  # the end of the line before was part of the payload
            self.owed = False
            self.take(b"\r\n"[: self.left])
            self.left -= 2
            if self.left <= 0:
                self.end()
        if self.state == "between":
            if data == b"WARC/1.0" or data == b"WARC/1.1":
                self.state, self.headers = "headers", {}
        elif self.state == "headers":
            if data:
                name, _, value = data.partition(b":")
                self.headers[name.strip().lower()] = value.strip().decode()
            else:
                self.begin()
        elif self.state == "http":
            self.left -= len(data) + 2
            if not data:
                self.state = "payload"
            if self.left <= 0:
                self.end()
        else:
            self.take(data[: self.left])
            self.left -= len(data)
            if self.left <= 0:
                self.end()
            else:  # whether a line end follows shows with the next line
                self.owed = True

    def begin(self) -> None:
        get = self.headers.get
        self.left = int(get(b"content-length", "0"))
        kind = get(b"warc-type", "")
        if kind != "continuation" or self.origin is None:
            own = b"warc-segment-origin-id" if kind == "continuation" else b"warc-record-id"
            self.origin = (
                get(own, "").strip("<>"),
                kind,
                get(b"warc-refers-to", "").strip("<>") or None,
                get(b"warc-target-uri"),
            )
            self.hash, self.size, self.number, self.waiting = hashlib.sha256(), 0, 0, []
            self.held = 0
        http = kind == "response" and get(b"content-type", "").startswith("application/http")
        self.state = "http" if http else "payload"
        if self.left == 0:
            self.end()

    def take(self, data: bytes) -> None:
        if not data:
            return
        self.hash.update(data)
        self.size += len(data)
        self.held += len(data)
        if self.with_chunks:
            self.waiting.append(data)
        if self.held >= self.chunk_bytes:
            self.emit(False)

    def emit(self, last: bool) -> None:
        size, digest = self.size, self.hash.hexdigest()
        if self.origin[1] == "revisit":
            size = int(self.headers.get(b"x-payload-length", "0"))
            digest = self.headers.get(b"warc-payload-digest", "").removeprefix("sha256:")
        chunk = b"".join(self.waiting) if self.with_chunks else None
        self.out.append((*self.origin, self.number, size, digest, last, chunk))
        self.number, self.waiting, self.held = self.number + 1, [], 0

    def end(self) -> None:
        self.state = "between"
        split = b"warc-segment-number" in self.headers
        if not split or b"warc-segment-total-length" in self.headers:
            self.emit(True)


def read_archive(
    spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, with_chunks: bool = True
) -> DataFrame:
    """Chunk rows in file order; payload_bytes and payload_digest cover the payload up to and
    including the row, `last` marks the row that completes its record. Archives whose files are
    not split by Spark, as gzip files are."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current, held = _Reader(chunk_bytes, with_chunks), None, 0
        for batch in batches:
            for file, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != current:
                    reader.restart()
                    current = file
                reader.line(data)
                held += len(data) if with_chunks else 0
                if len(reader.out) >= 5_000 or held >= 8 * chunk_bytes:
                    yield rows(_CHUNKS, list(zip(*reader.out, strict=True)) or [[]] * 9)
                    reader.out, held = [], 0
        if reader.out:
            yield rows(_CHUNKS, list(zip(*reader.out, strict=True)))

    lines = spark.read.option("lineSep", EOL).text(path)
    # The file's number tells files that share a partition apart.
    return lines.select(
        F.xxhash64(F.input_file_name()).alias("file"), col("value").cast("binary").alias("line")
    ).mapInArrow(read, _CHUNKS_DDL)


def report(pages: DataFrame) -> DataFrame:
    """Write all pages to an archive in the shared folder and describe the records read back:
    page_id, payload_bytes, payload_digest, record_type, refers_to."""
    path = new_path(pages.sparkSession, "warc")
    write_archive(with_revisits(pages), path)
    back = read_archive(pages.sparkSession, path, with_chunks=False).where("last")

    def number(name: str) -> Column:
        return F.expr(f"try_cast(substring({name}, {len(ID_PREFIX) + 1}) AS long)").alias(name)

    return back.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to"),
    )


ORACLE = """
WITH page AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), grouped AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM page
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM grouped
"""
