"""Line dedup: drop lines that many documents share, keeping them in one document.

A line's key is the stripped line in ASCII lower case. Keys long enough that occur in enough
documents lose all their lines except those of the largest doc_id that holds them.

Method. Every document emits one row per distinct key: a 128-bit hash and the positions.
These rows are range-partitioned by (hash, document), so even a key that a third of all
documents hold is spread over several tasks, and sorted by (hash, document descending,
position). One pass streams over each partition: the first document of a key keeps its lines,
later ones are dropped as soon as enough documents were seen. Only the keys at a partition's
two ends can continue in a neighbour; they are settled by a join with a table of two rows per
partition. The decisions become one compressed keep bitmap per document that loses lines.

Defined cases: a NULL text is one empty line. A row without doc_id counts for no key and
loses no line. Rows that repeat a doc_id count as one document, each with its own bitmap.
Extra columns pass through `without_shared_lines` and are ignored elsewhere. Repeats of a line
within the document that keeps it all stay.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.llm.common import SPACE, fresh, partitions, rows, sliced, stored, text_hash, texts

MIN_CHARS = 40
MIN_DOCS = 5

_KEYS = pa.schema(
    [
        ("h1", pa.int64()),
        ("h2", pa.int64()),
        ("doc_id", pa.int64()),
        ("row_hash", pa.int64()),
        ("n_lines", pa.int32()),
        ("positions", pa.binary()),
    ]
)
_KEYS_DDL = (
    "h1 long, h2 long, doc_id long, row_hash long, n_lines int, positions binary"
)
# What a row of the streaming pass says.
DROP, OPEN, EDGE = 0, 1, 2
_BITMAP = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("row_hash", pa.int64()),
        ("n_lines", pa.int32()),
        ("n_dropped", pa.int32()),
        ("bitmap", pa.binary()),
    ]
)


def _line_keys(min_chars: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            out = [[] for _ in range(5)]
            digests = []
            for doc, row_hash, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch), strict=True
            ):
                if doc is None:
                    continue
                found: dict[bytes, list[int]] = {}
                lines = text.decode().split("\n")
                for i, line in enumerate(lines):
                    if len(line) >= min_chars and len(line := line.strip(SPACE)) >= min_chars:
                        digest = xxhash.xxh3_128_digest(line.encode().lower())
                        found.setdefault(digest, []).append(i)
                digests.extend(found)
                out[0].extend([doc] * len(found))
                out[1].extend([row_hash] * len(found))
                out[2].extend([len(lines)] * len(found))
                out[3].extend(np.array(p, "<i4").tobytes() for p in found.values())
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield rows(_KEYS, [halves[:, 0], halves[:, 1], *out[:4]])

    return keys


def _stream(min_docs: int):
    """Decide one sorted partition, holding at most the rows of min_docs - 1 documents.

    Yields DROP rows, OPEN rows (undecided here), and an EDGE row with the number of documents
    (n_lines) and the largest doc_id for the first and the last key.
    """
    schema = pa.schema([("kind", pa.int32()), *_KEYS])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = top = last = None
        count, first, waiting = 0, True, []
        out: list[tuple] = []

        def edge():
            out.append((EDGE, *key, top, 0, count, None))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != key:
                    if key is not None and first:
                        edge()
                        first = False
                    elif key is None:
                        first = True
                    key, top, last, count, waiting = row[:2], row[2], row[2], 1, []
                    starts_here = not first
                elif row[2] != last:
                    last, count = row[2], count + 1
                if first:  # may have begun in the partition before
                    out.append((OPEN, *row))
                elif count >= min_docs:
                    if waiting:
                        out.extend((DROP, *w) for w in waiting if w[2] != top)
                        waiting = []
                    out.append((DROP, *row))
                else:
                    waiting.append(row)
                if len(out) >= 20_000:
                    yield rows(schema, list(zip(*out, strict=True)))
                    out.clear()
        if key is not None:
            edge()
            if not first and starts_here:
                out.extend((OPEN, *w) for w in waiting)
        if out:
            yield rows(schema, list(zip(*out, strict=True)))

    return decide


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines = batch.column(2).to_pylist()
        maps, dropped = [], []
        for n, parts in zip(n_lines, batch.column(3).to_pylist(), strict=True):
            keep = np.ones(n, bool)
            keep[np.frombuffer(b"".join(parts), "<i4")] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
            dropped.append(n - int(keep.sum()))
        yield rows(
            _BITMAP, [batch.column(0), batch.column(1), n_lines, dropped, maps]
        )


def keep_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """One row per document that loses lines: doc_id, row_hash (of its text), n_lines,
    n_dropped and `bitmap`, the zlib-compressed bits of the lines, 1 for kept."""
    keys = docs.select(
        col("doc_id").cast("long").alias("doc_id"), text_hash("text").alias("row_hash"), "text"
    ).mapInArrow(_line_keys(min_chars), _KEYS_DDL)
    by_key = keys.repartitionByRange(
        partitions(docs.sparkSession), "h1", "h2", col("doc_id").desc()
    ).sortWithinPartitions("h1", "h2", col("doc_id").desc(), "positions")
    found = stored(by_key.mapInArrow(_stream(min_docs), "kind int, " + _KEYS_DDL), "lines")
    # Two rows per partition at most, whatever the number of lines.
    edges = (
        found.where(col("kind") == EDGE)
        .groupBy("h1", "h2")
        .agg(F.sum("n_lines").alias("n_docs"), F.max("doc_id").alias("top"))
        .where(col("n_docs") >= min_docs)
    )
    settled = (
        found.where(col("kind") == OPEN)
        .join(F.broadcast(edges), ["h1", "h2"])
        .where(col("doc_id") < col("top"))
    )
    columns = ["doc_id", "row_hash", "n_lines", "positions"]
    return (
        found.where(col("kind") == DROP)
        .select(columns)
        .unionByName(settled.select(columns))
        .groupBy("doc_id", "row_hash")
        .agg(F.first("n_lines").alias("n_lines"), F.collect_list("positions").alias("positions"))
        .mapInArrow(
            _bitmaps, "doc_id long, row_hash long, n_lines int, n_dropped int, bitmap binary"
        )
    )


def kept_text(text: bytes, bitmap: bytes | None) -> bytes:
    """The lines a bitmap keeps, joined by a line feed."""
    if bitmap is None:
        return text
    lines = text.split(b"\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    return b"\n".join([line for line, k in zip(lines, keep.tolist(), strict=True) if k])


def _with_bitmaps(docs: DataFrame, bitmaps: DataFrame, bitmap: str) -> DataFrame:
    marks = bitmaps.select(
        col("doc_id").alias("_id"), col("row_hash").alias("_hash"), col("bitmap").alias(bitmap)
    ).alias("marks")
    left = docs.alias("docs")
    on = (col("docs.doc_id").cast("long") == col("marks._id")) & (
        text_hash(col("docs.text")) == col("marks._hash")
    )
    return left.join(marks, on, "left").select("docs.*", f"marks.{bitmap}")


def without_shared_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """The documents with their shared lines removed; all columns as they were."""
    mark = fresh(docs, "bitmap")
    marked = _with_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs), mark)
    at = docs.columns.index("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            columns = batch.columns[:-1]
            bits = batch.column(batch.num_columns - 1).to_pylist()
            if any(b is not None for b in bits):
                kept = [
                    t if b is None else kept_text(t.encode(), b).decode()
                    for t, b in zip(columns[at].to_pylist(), bits, strict=True)
                ]
                columns[at] = pa.array(kept, type=columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return marked.mapInArrow(apply, docs.schema)


_REPORT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_lines", pa.int64()),
        ("n_dropped", pa.int64()),
        ("kept_sha256", pa.string()),
    ]
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        out = [[], [], []]
        for text, bitmap in zip(texts(batch), batch.column(2).to_pylist(), strict=True):
            kept = kept_text(text, bitmap)
            n_lines = text.count(b"\n") + 1
            if bitmap is None:
                n_dropped = 0
            else:
                bits = np.frombuffer(zlib.decompress(bitmap), np.uint8)
                n_dropped = n_lines - int(np.unpackbits(bits, count=n_lines).sum())
            for column, value in zip(
                out, (n_lines, n_dropped, hashlib.sha256(kept).hexdigest()), strict=True
            ):
                column.append(value)
        yield rows(_REPORT, [batch.column(0), *out])


def line_report(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped and the SHA-256 of what stays."""
    slim = docs.select(col("doc_id").cast("long").alias("doc_id"), "text")
    marked = _with_bitmaps(slim, keep_bitmaps(slim, min_chars, min_docs), "bitmap")
    return marked.mapInArrow(
        _digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )


ORACLE = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), line AS (
  SELECT doc_id, p.pos, p.line,
         translate(trim(p.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM (
    SELECT doc_id, unnest(list_transform(string_split(text, chr(10)),
                          lambda line, pos: {'line': line, 'pos': pos})) AS p
    FROM doc
  )
), shared AS (
  SELECT line_key, max(doc_id) AS keeper
  FROM line
  WHERE length(line_key) >= 40
  GROUP BY line_key
  HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT line.doc_id, line.pos, line.line,
         shared.line_key IS NOT NULL AND line.doc_id <> shared.keeper AS dropped
  FROM line LEFT JOIN shared USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
         AS kept_sha256
FROM marked
GROUP BY doc_id
"""
