"""Benchmark decontamination over a distributed positional inverted index.

Method. The documents are indexed in blocks: each row of the stored index covers some whole
documents and holds, for every benchmark term in them, the sorted list of its positions. The
index is a table in the shared folder. From it come the corpus counts of all terms, which order
the terms of every window from the rarest on. A search intersects, block by block, the lists of
a window's terms after subtracting each term's offset, beginning with the rarest, and stops as
soon as nothing is left; windows with a term that the block lacks are never begun. What remains
are the exact phrase matches. Proximity matches need every term of a window within a span around
an occurrence of its rarest term, in any order.

The benchmark is the stated query set. It is cut into parts of at most PART_WORDS words; tasks
get one part at a time, so what is broadcast is bounded however large the benchmark is, and the
marks of several parts are merged per document.

Defined cases: NULL or empty texts have no words, no hits and are not contaminated; an item
without words has no window. Every row is judged by itself, so rows that repeat a doc_id, or
have none, get a row each. Equal item ids are one item; a benchmark row without item_id is no
item, in the SQL too. Extra columns pass through `uncontaminated` and are ignored elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.llm.common import fresh, rows, sliced, stored, text_hash, texts

WINDOW = 13
PERCENT = 5
PART_WORDS = 200_000

# Separators become blanks and A-Z lower case, all else stays: then bytes.split() gives words.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 32 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


@dataclass
class Windows:
    """The windows of one part of the benchmark, grouped by length, as term numbers."""

    terms: dict[bytes, int] = field(default_factory=dict)
    items: list[int] = field(default_factory=list)
    # length -> (rows of term numbers, item number of each row)
    by_length: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    # length -> offsets of each row, the rarest term first; set from the corpus counts
    order: dict[int, np.ndarray] = field(default_factory=dict)

    def rank(self, counts: np.ndarray) -> Windows:
        for length, (terms, _) in self.by_length.items():
            self.order[length] = np.argsort(counts[terms], axis=1, kind="stable")
        return self


def windows_of(items: list[tuple[int, bytes]], window: int = WINDOW) -> Windows:
    made = Windows()
    found: dict[int, set[tuple]] = {}
    numbers: dict[int, int] = {}
    for item_id, text in items:
        words = words_of(text)
        ids = [made.terms.setdefault(w, len(made.terms)) for w in words]
        length = min(window, len(ids))
        if length:
            item = numbers.setdefault(item_id, len(numbers))
            for i in range(len(ids) - length + 1):
                found.setdefault(length, set()).add((item, *ids[i : i + length]))
    made.items = list(numbers)
    for length, windows in found.items():
        table = np.array(sorted(windows), np.int64)
        made.by_length[length] = table[:, 1:], table[:, 0]
    return made


def _parts(benchmark: DataFrame, window: int) -> Iterator[Windows]:
    """Windows of the benchmark, at most about PART_WORDS words at a time (an item at least)."""
    part, size = [], 0
    items = benchmark.where("item_id IS NOT NULL").select(col("item_id").cast("long"), "text")
    for item_id, text in items.toLocalIterator():
        data = (text or "").encode()
        part.append((item_id, data))
        size += len(words_of(data))
        if size >= PART_WORDS:
            yield windows_of(part, window)
            part, size = [], 0
    if part:
        yield windows_of(part, window)


_INDEX_DDL = (
    "doc_ids array<long>, row_hashes array<long>, n_words array<int>, "
    "terms binary, sizes binary, positions binary"
)
_INDEX = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())),
        ("row_hashes", pa.list_(pa.int64())),
        ("n_words", pa.list_(pa.int32())),
        ("terms", pa.binary()),
        ("sizes", pa.binary()),
        ("positions", pa.binary()),
    ]
)


def build_index(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """The stored index: a row per block of documents. Terms are numbers, positions count the
    words of the block, with a gap of one between documents."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in sliced(batches, "text"):
            ids: list[int] = []
            n_words = []
            for text in texts(batch):
                words = words_of(text)
                n_words.append(len(words))
                ids.extend([number.get(w, -1) for w in words])
                ids.append(-1)
            known = np.array(ids, np.int32)
            at = np.flatnonzero(known >= 0)
            at = at[np.argsort(known[at], kind="stable")].astype("<i4")
            present, sizes = np.unique(known[at], return_counts=True)
            lists = (present.astype("<i4"), sizes.astype("<i4"), at)
            yield rows(
                _INDEX,
                [
                    [batch.column(0).to_pylist()],
                    [batch.column(1).to_pylist()],
                    [n_words],
                    *([x.tobytes()] for x in lists),
                ],
            )

    made = docs.select(
        col("doc_id").cast("long").alias("doc_id"), text_hash("text").alias("row_hash"), "text"
    ).mapInArrow(index, _INDEX_DDL)
    return stored(made, "postings")


def term_counts(index: DataFrame, n_terms: int) -> np.ndarray:
    """How often each term occurs in all documents; at most PART_WORDS numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for terms, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total[np.frombuffer(terms, "<i4")] += np.frombuffer(sizes, "<i4")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "n"])

    sums = (
        index.select("terms", "sizes")
        .mapInArrow(count, "term long, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros(n_terms, np.int64)
    counts[sums["term"].to_numpy()] = sums["n"].to_numpy()
    return counts


class _Block:
    """One row of the index."""

    def __init__(self, n_terms: int, n_words, terms, sizes, positions):
        self.n_words = np.array(n_words, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.n_words + 1)])
        self.positions = np.frombuffer(positions, "<i4")
        self.first = np.zeros(n_terms + 1, np.int64)
        self.size = np.zeros(n_terms + 1, np.int64)
        terms, sizes = np.frombuffer(terms, "<i4"), np.frombuffer(sizes, "<i4")
        self.size[terms] = sizes
        self.first[terms] = np.cumsum(sizes) - sizes

    def of(self, term: int) -> np.ndarray:
        return self.positions[self.first[term] : self.first[term] + self.size[term]]

    def phrases(self, windows: Windows) -> Iterator[tuple[int, int, np.ndarray]]:
        """(item number, length, start positions) of every window that occurs."""
        for length, (terms, items) in windows.by_length.items():
            possible = np.flatnonzero((self.size[terms] > 0).all(axis=1))
            for row in possible.tolist():
                starts = None
                for offset in windows.order[length][row].tolist():
                    own = self.of(terms[row, offset])
                    if starts is None:
                        starts = own - offset
                        continue
                    wanted = starts + offset
                    at = np.searchsorted(own, wanted)
                    at[at == len(own)] = 0
                    starts = starts[own[at] == wanted]
                    if not starts.size:
                        break
                if starts.size:
                    yield int(items[row]), length, starts

    def near(self, windows: Windows, span: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """(item number, length, positions of the rarest term) where all terms of a window lie
        within `span` words of that position, inside the same document."""
        for length, (terms, items) in windows.by_length.items():
            possible = np.flatnonzero((self.size[terms] > 0).all(axis=1))
            for row in possible.tolist():
                ordered = terms[row, windows.order[length][row]]
                anchors = self.of(ordered[0])
                doc = np.searchsorted(self.starts, anchors, side="right") - 1
                low = np.maximum(anchors - span, self.starts[doc])
                high = np.minimum(anchors + span, self.starts[doc + 1] - 2)
                found = np.ones(len(anchors), bool)
                for term in np.unique(ordered[1:]).tolist():
                    own = self.of(term)
                    at = np.searchsorted(own, low)
                    found &= (at < len(own)) & (own[np.minimum(at, len(own) - 1)] <= high)
                if found.any():
                    yield int(items[row]), length, anchors[found]


def _blocks(batches: Iterator[pa.RecordBatch], n_terms: int):
    for batch in batches:
        for i in range(batch.num_rows):
            row = [c[i].as_py() for c in batch.columns]
            yield row[0], row[1], _Block(n_terms, *row[2:])


_MARKS_DDL = (
    "doc_id long, row_hash long, n_words int, starts binary, lengths binary, items array<long>"
)
_MARKS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("row_hash", pa.int64()),
        ("n_words", pa.int32()),
        ("starts", pa.binary()),
        ("lengths", pa.binary()),
        ("items", pa.list_(pa.int64())),
    ]
)


def _runs(covered: np.ndarray) -> tuple[bytes, bytes]:
    """Starts and lengths of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
    return edges[::2].astype("<i4").tobytes(), (edges[1::2] - edges[::2]).astype("<i4").tobytes()


def _marks(index: DataFrame, windows: Windows) -> DataFrame:
    """Per document the runs of hit words and the items that occur in it."""
    shared = index.sparkSession.sparkContext.broadcast(windows)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for doc_ids, row_hashes, block in _blocks(batches, len(windows.terms)):
            change = np.zeros(block.starts[-1] + 1, np.int64)
            items: list[set[int]] = [set() for _ in doc_ids]
            for item, length, starts in block.phrases(windows):
                np.add.at(change, starts, 1)
                np.add.at(change, starts + length, -1)
                docs = np.unique(np.searchsorted(block.starts, starts, side="right") - 1)
                for doc in docs.tolist():
                    items[doc].add(windows.items[item])
            covered = np.cumsum(change) > 0
            runs = [
                _runs(covered[s : s + n]) if found else (b"", b"")
                for s, n, found in zip(
                    block.starts.tolist(), block.n_words.tolist(), items, strict=False
                )
            ]
            yield rows(
                _MARKS,
                [
                    doc_ids,
                    row_hashes,
                    block.n_words,
                    [r[0] for r in runs],
                    [r[1] for r in runs],
                    [sorted(x) for x in items],
                ],
            )

    return index.mapInArrow(search, _MARKS_DDL)


def matches(
    docs: DataFrame, benchmark: DataFrame, span: int = 20, window: int = WINDOW
) -> DataFrame:
    """doc_id, item_id, kind ('phrase' or 'proximity'), position (a word number), n_words of the
    window. A phrase starts at its position; the rarest term of a proximity match stands there.
    Windows of neighbouring positions give a row each."""
    ddl = "doc_id long, item_id long, kind string, position int, window_words int"
    result = docs.sparkSession.createDataFrame([], ddl)
    for windows in _parts(benchmark, window):
        index = build_index(docs, windows.terms)
        windows.rank(term_counts(index, len(windows.terms)))
        shared = docs.sparkSession.sparkContext.broadcast(windows)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            windows = shared.value
            for doc_ids, _, block in _blocks(batches, len(windows.terms)):
                for kind, found in (
                    ("phrase", block.phrases(windows)),
                    ("proximity", block.near(windows, span)),
                ):
                    for item, length, at in found:
                        doc = np.searchsorted(block.starts, at, side="right") - 1
                        n = len(at)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([doc_ids[d] for d in doc.tolist()], pa.int64()),
                                pa.array([windows.items[item]] * n, pa.int64()),
                                pa.array([kind] * n),
                                pa.array((at - block.starts[doc]).astype(np.int32)),
                                pa.array([length] * n, pa.int32()),
                            ],
                            ["doc_id", "item_id", "kind", "position", "window_words"],
                        )

        result = result.unionByName(index.mapInArrow(search, ddl))
    return result


_REPORT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("row_hash", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("n_items", pa.int64()),
        ("items_sha256", pa.string()),
        ("contaminated", pa.bool_()),
    ]
)
_REPORT_DDL = (
    "doc_id long, row_hash long, n_words long, n_hit long, n_items long, "
    "items_sha256 string, contaminated boolean"
)


def _report(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, n_items, digests, verdicts = [], [], [], []
            columns = [c.to_pylist() for c in batch.columns[2:]]
            for n_words, starts, lengths, items in zip(*columns, strict=True):
                change = np.zeros(n_words + 1, np.int64)
                starts = np.frombuffer(starts, "<i4")
                np.add.at(change, starts, 1)
                np.add.at(change, starts + np.frombuffer(lengths, "<i4"), -1)
                hit = int((np.cumsum(change) > 0).sum())
                names = sorted({str(i) for i in items})
                hits.append(hit)
                n_items.append(len(names))
                digests.append(hashlib.sha256(",".join(names).encode()).hexdigest())
                verdicts.append(hit > 0 and 100 * hit >= percent * n_words)
            yield rows(
                _REPORT,
                [*batch.columns[:2], batch.column(2), hits, n_items, digests, verdicts],
            )

    return run


def _judged(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = PERCENT
) -> DataFrame:
    marks = []
    for windows in _parts(benchmark, window):
        index = build_index(docs, windows.terms)
        windows.rank(term_counts(index, len(windows.terms)))
        marks.append(_marks(index, windows))
    if not marks:
        marks.append(_marks(build_index(docs, {}), Windows()))
    merged = marks[0]
    if len(marks) > 1:
        # Every part has the same rows; equal rows (same id and text) have equal marks.
        for more in marks[1:]:
            merged = merged.unionByName(more)
        copies = F.count("*") / len(marks)
        merged = (
            merged.groupBy("doc_id", "row_hash", "n_words")
            .agg(
                F.expr("reduce(collect_list(starts), X'', (a, b) -> concat(a, b))").alias("starts"),
                F.expr("reduce(collect_list(lengths), X'', (a, b) -> concat(a, b))").alias(
                    "lengths"
                ),
                F.flatten(F.collect_list("items")).alias("items"),
                copies.cast("int").alias("copies"),
            )
            .withColumn("copies", F.explode(F.sequence(F.lit(1), "copies")))
            .drop("copies")
            .select(marks[0].columns)
        )
    return merged.mapInArrow(_report(percent), _REPORT_DDL)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return _judged(docs, benchmark).drop("row_hash")


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated; all columns as they were."""
    judged = _judged(docs, benchmark).where("contaminated")
    id_name, hash_name = fresh(docs, "bad_id"), fresh(docs, "bad_hash")
    bad = judged.select(col("doc_id").alias(id_name), col("row_hash").alias(hash_name))
    on = docs["doc_id"].cast("long").eqNullSafe(bad[id_name]) & (
        text_hash(docs["text"]) == bad[hash_name]
    )
    return docs.join(bad, on, "left_anti")


ORACLE = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), item AS (
  SELECT item_id, words, least(13, len(words)) AS n
  FROM (
    SELECT item_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
    WHERE item_id IS NOT NULL
  )
  WHERE len(words) > 0
), wanted AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS phrase
  FROM (SELECT item_id, n, words, unnest(range(1, len(words) - n + 2)) AS i FROM item)
), passage AS (
  SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS phrase
  FROM (
    SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
    FROM doc, (SELECT DISTINCT n FROM wanted)
    WHERE len(words) >= n
  )
), hit AS (
  SELECT doc_id, item_id, i, n FROM passage JOIN wanted USING (n, phrase)
), hit_words AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hit)
  GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hit)
  GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
