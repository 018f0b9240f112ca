"""Ranked lexical search: the highest-scoring documents for each benchmark item.

Scores are a whole-number form of BM25: a term's weight falls with the number of documents that
hold it, its gain saturates with its count and is damped by the document's length `m`.

Method (bag deduplication). Documents are cut down to the items' vocabulary: a bag of (term,
count) pairs, packed in bytes. Two documents with equal bags and equal `m` score alike for every
item, so bags are hashed, and those of equal hash grouped by their bytes and `m`, which verifies
them. A class keeps its `top` smallest doc_ids, as more can never be returned. Each class is
scored once, by postings from terms to items; a task keeps the best classes of each item, and
the members of those are expanded by ascending doc_id and ranked.

The items are taken in parts of about `part_terms` (item, term) pairs, of which the driver and
each task hold one, and every part goes over all documents. Only one item's own distinct terms
are never divided. Counts over the corpus come from all documents in every part.

Defined cases: a NULL or empty text has no terms; such a document counts nowhere and such an item
returns nothing. Every row of documents is a document of its own, so repeated rows are ranked one
after the other. A NULL doc_id ranks behind all others of its score. Rows that repeat an item_id
are one item with the terms of all; those without item_id are one item too. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.llm.common import rows, sliced, stored, texts

TOP = 50
PART_TERMS = 200_000
# Cells and postings that a task expands at once. Bounds a worker's memory, not the data.
CELLS = 2_000_000

# Everything that is no letter, digit or byte of a longer character parts terms.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 32
    for b in range(256)
)
_BAG = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("bag", pa.binary())])
_FOUND = pa.schema(
    [("item_id", pa.int64()), ("score", pa.int64()), ("members", pa.list_(pa.int64()))]
)
_LAST = np.iinfo(np.int64).max


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split(b" ") if text else []


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("item_id", pa.int64()), ("term", pa.binary())])
    for batch in sliced(batches, "text"):
        for item, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
            found = list({t for t in terms(text) if t})
            for i in range(0, len(found), 50_000):
                part = found[i : i + 50_000]
                yield rows(schema, [[item] * len(part), part])


def _bags(vocabulary):
    """Each document with a term as its number of terms and its bag over the vocabulary."""

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in sliced(batches, "text"):
            docs, counts, packed = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                count = Counter(terms(text))
                count.pop(b"", None)
                if not count:
                    continue
                bag = sorted((k, c) for t, c in count.items() if (k := number(t)) is not None)
                docs.append(doc)
                counts.append(count.total())
                packed.append(np.array(bag, "<i4").tobytes())
            yield rows(_BAG, [docs, counts, packed])

    return bags


def _doc_counts(size: int):
    """How many bags of the partition hold each term: one row per term found."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            entries = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4")
            held += np.bincount(entries[::2], minlength=size)
        at = np.flatnonzero(held)
        yield rows(pa.schema([("term", pa.int64()), ("df", pa.int64())]), [at, held[at]])

    return count


class _Best:
    """The best classes of each item so far, by score and then smallest doc_id."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.least = np.ones(n_items, np.int64)  # a lower score cannot be among the best
        self.item = self.score = self.first = self.key = np.empty(0, np.int64)
        self.members: dict[int, list] = {}

    def add(self, item, score, first, key, members: dict[int, list]) -> None:
        self.item = np.concatenate([self.item, item])
        self.score = np.concatenate([self.score, score])
        self.first = np.concatenate([self.first, first])
        self.key = np.concatenate([self.key, key])
        order = np.lexsort((self.key, self.first, -self.score, self.item))
        ordered = self.item[order]
        rank = np.arange(len(order)) - np.searchsorted(ordered, ordered)
        self.least[ordered[rank == self.top - 1]] = self.score[order][rank == self.top - 1]
        keep = order[rank < self.top]
        self.item, self.score = self.item[keep], self.score[keep]
        self.first, self.key = self.first[keep], self.key[keep]
        self.members |= members
        self.members = {k: self.members[k] for k in np.unique(self.key).tolist()}


def _blocks(n_postings: np.ndarray, owner: np.ndarray, n_rows: int, n_items: int):
    """Cut classes into runs whose cells and postings stay within CELLS, one class at least."""
    per_row = np.bincount(owner, weights=n_postings, minlength=n_rows)
    start = size = 0
    for i, n in enumerate(per_row.tolist()):
        if i > start and (size + n > CELLS or (i + 1 - start) * n_items > CELLS):
            yield start, i
            start, size = i, 0
        size += n
    if n_rows > start:
        yield start, n_rows


def _scored(model, top: int):
    """The best classes of every item among the classes of a partition."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, starts, items, item_ids = model.value
        n_items, best, base = len(item_ids), _Best(len(item_ids), top), 0
        for batch in batches:
            bags = batch.column(0).to_pylist()
            length = np.array([len(b) // 8 for b in bags])
            entries = np.frombuffer(b"".join(bags), "<i4").astype(np.int64)
            term, tf = entries[::2], entries[1::2]
            owner = np.repeat(np.arange(len(bags)), length)
            m = batch.column(1).to_numpy()[owner]
            gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            n_postings = starts[term + 1] - starts[term]
            members = batch.column(2).to_pylist()
            first = np.array([_LAST if d[0] is None else d[0] for d in members], np.int64)
            ends = np.concatenate([[0], np.cumsum(length)])
            for lo, hi in _blocks(n_postings, owner, len(bags), n_items):
                part = slice(ends[lo], ends[hi])
                n = n_postings[part]
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = items[np.repeat(starts[term[part]], n) + within]
                cells = np.zeros((hi - lo) * n_items, np.int64)
                np.add.at(
                    cells, np.repeat(owner[part] - lo, n) * n_items + at, np.repeat(gain[part], n)
                )
                found = np.flatnonzero(cells >= np.tile(best.least, hi - lo))
                row, item = found // n_items + lo, found % n_items
                kept = {base + i: members[i] for i in np.unique(row).tolist()}
                best.add(item, cells[found], first[row], base + row, kept)
            base += len(bags)
        for i in range(0, len(best.item), 5000):
            part = slice(i, i + 5000)
            yield rows(
                _FOUND,
                [
                    [item_ids[k] for k in best.item[part].tolist()],
                    best.score[part],
                    [best.members[k] for k in best.key[part].tolist()],
                ],
            )

    return score


def _classes(bags: DataFrame, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(bag, m, members): documents that score alike, by their `top` smallest doc_ids."""
    damped = bags.where(F.octet_length("bag") > 0).select(
        "doc_id",
        "bag",
        F.expr(f"100 - 50 + ((50 * n * {n_docs}L) div {n_terms}L)").alias("m"),
    )
    hashed = damped.withColumn("h", F.xxhash64("bag", "m"))
    alike = Window.partitionBy("h", "bag", "m").orderBy(col("doc_id").asc_nulls_last())
    member = F.struct(col("doc_id").isNull().alias("absent"), "doc_id")
    return (
        hashed.withColumn("k", F.row_number().over(alike))
        .where(col("k") <= top)
        .groupBy("h", "bag", "m")
        .agg(F.sort_array(F.collect_list(member)).alias("members"))
        .select("bag", "m", col("members.doc_id").alias("members"))
    )


def _search(docs: DataFrame, pairs: list, top: int) -> DataFrame:
    """The ranked documents of one part of the items, given as (item_id, term) pairs."""
    context = docs.sparkSession.sparkContext
    number = {t: i for i, t in enumerate(sorted({bytes(t) for _, t in pairs}))}
    item_ids = sorted({i for i, _ in pairs}, key=lambda i: (i is None, i))
    place = {i: k for k, i in enumerate(item_ids)}
    postings = np.array(sorted((number[bytes(t)], place[i]) for i, t in pairs), np.int64)
    starts = np.searchsorted(postings[:, 0], np.arange(len(number) + 1))

    bags = stored(
        docs.mapInArrow(_bags(context.broadcast(number)), "doc_id long, n long, bag binary"),
        "bags",
    )
    n_docs, n_terms = bags.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(number), np.int64)
    counted = bags.select("bag").mapInArrow(_doc_counts(len(number)), "term long, df long")
    for row in counted.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        held[row.term] = row.df
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in held.tolist()]
    model = (np.array(weights, np.int64), starts, postings[:, 1], item_ids)
    found = _classes(bags, n_docs, max(n_terms, 1), top).mapInArrow(
        _scored(context.broadcast(model), top), "item_id long, score long, members array<long>"
    )
    return found.select("item_id", "score", F.explode("members").alias("doc_id"))


def report(
    docs: DataFrame, benchmark: DataFrame, top: int = TOP, part_terms: int = PART_TERMS
) -> DataFrame:
    """Per item its `top` documents: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    items = stored(
        benchmark.select(col("item_id").cast("long").alias("item_id"), "text")
        .mapInArrow(_item_terms, "item_id long, term binary")
        .distinct(),
        "items",
    )
    slim = docs.select(col("doc_id").cast("long").alias("doc_id"), "text")
    n_parts = -(-items.count() // part_terms)
    part = F.pmod(F.xxhash64("item_id"), F.lit(max(n_parts, 1)))
    found = None
    for k in range(n_parts):
        pairs = [tuple(r) for r in items.where(part == k).collect()]
        if pairs:
            own = _search(slim, pairs, top)
            found = own if found is None else found.unionByName(own)
    if found is None:
        found = spark.createDataFrame([], "item_id long, score long, doc_id long")
    best = Window.partitionBy("item_id").orderBy(
        col("score").desc(), col("doc_id").asc_nulls_last()
    )
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(col("rank") <= top)
        .select("item_id", "rank", "doc_id", "score")
    )


ORACLE = r"""
WITH item_term AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS found
  FROM documents
), size AS (
  SELECT count(*) AS n_docs, sum(len(found))::BIGINT AS n_terms FROM doc WHERE len(found) > 0
), entry AS (
  SELECT r, doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT r, doc_id, len(found) AS n, unnest(found) AS term FROM doc)
  WHERE term IN (SELECT term FROM item_term)
  GROUP BY r, doc_id, term
), weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM entry, size GROUP BY term
), gain AS (
  SELECT r, doc_id, term,
         w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS gain
  FROM entry JOIN weight USING (term), size
), scored AS (
  SELECT item_id, r, doc_id, sum(gain)::BIGINT AS score
  FROM gain JOIN item_term USING (term)
  GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
