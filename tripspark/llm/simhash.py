"""SimHash near-dedup: documents whose 64-bit fingerprints differ in few bits.

Method. Fingerprints are collapsed to distinct values. Fingerprints within the distance agree in
at least two of distance + 2 equal blocks of bits, so each value is keyed by every pair of
blocks and only values that share a key are compared. A bucket of values is compared bit-sliced:
the values' bits are stored as vertical planes, one machine word holding one bit of 64 values;
each plane is XORed with a query's bit and added to carry-save counters, which update 64
distances at once, and words whose 64 distances all exceed the radius are abandoned. Large
buckets are cut into tiles, every pair of tiles being a task's unit of work, so no bucket has to
fit into a task. A unit returns a spanning forest of its links, never all pairs; the components
of all links are found by star steps over written tables.

Defined cases: a text without words, empty or NULL, has fingerprint zero and links like any
other. Rows that repeat a doc_id are fingerprinted one by one. A NULL doc_id takes part but is
never the component's id, unless no member has one (then it is NULL). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit

from tripspark.llm.common import fresh, partitions, rows, sliced, stored, text_hash, texts
from tripspark.llm.graph import components

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
TILE = 2048  # values of a unit's side
CHUNK = 255  # rows whose bits fit into byte-wide counters


def _shingles(text: bytes, size: int) -> Iterator[bytes]:
    words = text.lower().split()
    if len(words) <= size:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))


def fingerprints_of(batch: list[bytes], size: int = SHINGLE_WORDS) -> np.ndarray:
    """The fingerprints of some texts as uint64: a bit is set if over half the hashes have it."""
    parts, counts = [], np.zeros(len(batch), np.int64)
    for i, text in enumerate(batch):
        digests = b"".join(map(xxhash.xxh64_digest, _shingles(text, size), repeat(42)))
        counts[i] = len(digests) // 8
        parts.append(digests)
    result = np.zeros(len(batch), np.uint64)
    full = np.flatnonzero(counts)
    if not full.size:
        return result
    bits = np.unpackbits(np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 8), axis=1)
    # Sums in bytes over at most CHUNK rows of one document, then over its chunks.
    ends = np.cumsum(counts[full])
    starts = ends - counts[full]
    chunk_starts = [np.arange(s, e, CHUNK) for s, e in zip(starts, ends, strict=True)]
    sums = np.add.reduceat(bits.view(np.uint64), np.concatenate(chunk_starts), axis=0)
    of_doc = np.cumsum([0, *(len(c) for c in chunk_starts[:-1])])
    ones = np.add.reduceat(sums.view(np.uint8).astype(np.uint32), of_doc, axis=0)
    packed = np.packbits(2 * ones > counts[full][:, None], axis=1)
    result[full] = packed.view(">u8").ravel()
    return result


_PRINTS = pa.schema([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("fp", pa.int64())])


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, row_hash of the text, and the fingerprint `fp` as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            fps = fingerprints_of(texts(batch), size).view(np.int64)
            yield rows(_PRINTS, [batch.column(0), batch.column(1), fps])

    return docs.select(
        col("doc_id").cast("long").alias("doc_id"), text_hash("text").alias("row_hash"), "text"
    ).mapInArrow(run, "doc_id long, row_hash long, fp long")


def planes(values: np.ndarray, bit_numbers: list[int]) -> np.ndarray:
    """Vertical bit planes: row b holds bit bit_numbers[b] of all values, 64 per word."""
    words = -(-len(values) // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[: len(values)] = values
    out = np.empty((len(bit_numbers), words), np.uint64)
    for row, bit in enumerate(bit_numbers):
        plane = ((padded >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        out[row] = np.packbits(plane, bitorder="little").view("<u8")
    return out


def close_pairs(
    queries: np.ndarray, values: np.ndarray, bit_numbers: list[int], radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (query, value) that differ in at most `radius` of the given bits."""
    sliced_values = planes(values, bit_numbers)
    words = sliced_values.shape[1]
    q = np.repeat(np.arange(len(queries)), words)
    w = np.tile(np.arange(words), len(queries))
    width = (radius + 1).bit_length()
    counters = np.zeros((width, q.size), np.uint64)
    over = np.zeros(q.size, np.uint64)
    ones = ~np.uint64(0)
    tail = len(values) % 64
    if tail:  # lanes without a value
        over[w == words - 1] = ones << np.uint64(tail)
    for row, bit in enumerate(bit_numbers):
        flip = (queries >> np.uint64(bit) & np.uint64(1)) * ones
        carry = sliced_values[row][w] ^ flip[q]
        for level in range(width):  # add one bit to 64 counters
            counters[level], carry = counters[level] ^ carry, counters[level] & carry
        over |= carry | _exceeds(counters, radius)
        if row % 4 == 3:
            live = over != ones
            if not live.any():
                return np.empty(0, np.int64), np.empty(0, np.int64)
            if not live.all():
                q, w, over, counters = q[live], w[live], over[live], counters[:, live]
    near = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(near)
    return q[at], w[at] * 64 + lane


def _exceeds(counters: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is over the radius, compared bit by bit from the top."""
    greater = np.zeros(counters.shape[1], np.uint64)
    equal = ~greater
    for level in reversed(range(len(counters))):
        if radius >> level & 1:
            equal &= counters[level]
        else:
            greater |= equal & counters[level]
            equal &= ~counters[level]
    return greater


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked positions the least label, repeatedly, until nothing changes."""
    while True:
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return
        low, high = np.minimum(la, lb)[differ], np.maximum(la, lb)[differ]
        np.minimum.at(labels, high, low)
        while not np.array_equal(shorter := labels[labels], labels):
            labels[:] = shorter


def _links_of(left: np.ndarray, right: np.ndarray, bit_numbers: list[int], radius: int):
    """A spanning forest of the links between two sorted sets (or within one): (a, b) values."""
    both = np.unique(np.concatenate([left, right]))
    labels = np.arange(len(both))
    at = np.searchsorted(both, right)
    for start in range(0, len(left), 256):
        part = left[start : start + 256]
        q, v = close_pairs(part, right, bit_numbers, radius)
        _merge(labels, np.searchsorted(both, part)[q], at[v])
    child = np.flatnonzero(labels != np.arange(len(both)))
    return both[child], both[labels[child]]


def _blocks(distance: int) -> list[list[int]]:
    count = distance + 2
    edges = [BITS * i // count for i in range(count + 1)]
    return [list(range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]


def _key(fp: Column, pair: tuple[list[int], list[int]]) -> Column:
    def part(bits: list[int]) -> Column:
        return F.shiftrightunsigned(fp, bits[0]).bitwiseAND(lit((1 << len(bits)) - 1))

    first, second = pair
    return F.shiftleft(part(second), len(first)).bitwiseOR(part(first))


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def links(prints: DataFrame, distance: int = MAX_DISTANCE, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that span all pairs within the distance."""
    pairs = list(combinations(_blocks(distance), 2))
    # The bits that a bucket's values need not share.
    compared = [
        [b for b in range(BITS) if b not in {*first, *second}] for first, second in pairs
    ]
    keyed = prints.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(lit(i).alias("pair"), _key(col("fp"), pair).alias("key"))
                    for i, pair in enumerate(pairs)
                ]
            )
        ).alias("k"),
    ).select("fp", "k.pair", "k.key")
    sizes = keyed.groupBy("pair", "key").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(col("n") / tile).cast("int")
    mine = F.pmod(F.xxhash64("fp"), col("tiles")).cast("int")
    units = (
        keyed.join(sizes, ["pair", "key"])
        .withColumn("tiles", tiles)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(lit(0), col("tiles") - 1)))
        .select(
            "pair",
            "key",
            F.least("mine", "other").alias("low"),
            F.greatest("mine", "other").alias("high"),
            "mine",
            "fp",
        )
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (
            row
            for batch in batches
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)
        )
        a, b = [], []
        for (pair, _, low, high), unit in groupby(stream, key=lambda row: row[:4]):
            unit = list(unit)
            left = np.array([r[5] for r in unit if r[4] == low], np.int64).view(np.uint64)
            right = left
            if low != high:
                right = np.array([r[5] for r in unit if r[4] == high], np.int64).view(np.uint64)
            if left.size and right.size:
                child, parent = _links_of(left, right, compared[pair], distance)
                a.extend(child.view(np.int64).tolist())
                b.extend(parent.view(np.int64).tolist())
            if len(a) >= 20_000:
                yield rows(_LINKS, [a, b])
                a, b = [], []
        yield rows(_LINKS, [a, b])

    unit = ["pair", "key", "low", "high"]
    return (
        units.repartition(partitions(prints.sparkSession), *unit)
        .sortWithinPartitions(*unit)
        .mapInArrow(compare, "a long, b long")
    )


def groups(
    docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE
) -> DataFrame:
    """Per document: doc_id, row_hash, fp, component_id (least doc_id reachable by links).

    Fingerprints of more than a quarter of a partition's share of rows, of which there are four a
    partition at most, meet their rows by a broadcast and the others by a shuffle.
    """
    prints = stored(fingerprints(docs, size), "prints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    roots = components(links(distinct, distance))
    placed = distinct.join(roots, col("fp") == col("node"), "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root")
    )
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = stored(placed.join(ids, "root").select("fp", "n", "component_id", "root"), "groups")
    share = max(prints.count() // (4 * partitions(docs.sparkSession)), 1)
    hot = F.broadcast(by_print.where(col("n") > share))
    others = prints.join(hot.select("fp"), "fp", "left_anti")
    found = prints.join(hot, "fp").unionByName(
        others.join(by_print.where(col("n") <= share), "fp")
    )
    return found.select("doc_id", "row_hash", "fp", "component_id", "root")


def report(docs: DataFrame) -> DataFrame:
    return groups(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_per_group(
    docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE
) -> DataFrame:
    """The documents of the least doc_id of each group; all columns as they were.

    Of rows that repeat this doc_id the one with the least text hash stays, once.
    """
    found = groups(docs, size, distance)
    first = F.min(F.struct(col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash"))
    # The row's identity as plain columns without NULLs, so that the rows which the semi join
    # brings together need not be moved again to drop repeated ones.
    names = [fresh(docs, n) for n in ("chosen_id", "chosen_no_id", "chosen_hash")]

    def identity(doc_id: Column, row_hash: Column) -> list[Column]:
        parts = (F.coalesce(doc_id, lit(0).cast("long")), doc_id.isNull(), row_hash)
        return [part.alias(name) for part, name in zip(parts, names, strict=True)]

    chosen = (
        found.groupBy("root")
        .agg(first.alias("c"))
        .select(*identity(col("c.doc_id"), col("c.row_hash")))
        .distinct()
    )
    marked = docs.select("*", *identity(col("doc_id").cast("long"), text_hash("text")))
    return marked.join(chosen, names, "left_semi").dropDuplicates(names).select(docs.columns)
