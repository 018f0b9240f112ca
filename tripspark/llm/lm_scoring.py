"""LM scoring by cross-entropy difference of two matched bigram models.

Method. A target model is counted on the documents labelled good and not toxic, a background model
on all documents. Both share one vocabulary: every word of the corpus. They have the same order,
smoothing and mass: the background's counts are scaled to the target's total, so that a
difference between them is one of distribution and not of size. A document's score is the mean
over its words of the target's loss less the background's; the lower, the more it reads like
the target.

Tasks cut their documents into slices of about SLICE bytes. The keys of a slice are 64-bit hashes of
its distinct words and word pairs. They are sorted, divided at fixed bounds into parts of the hash
range and sent as one block a part: differences and counts, compressed. A part is added up over all
slices at once, and each slice gets a block of sums in the order of its own keys, so no key comes
back. Keys are hashes, so parts are of equal size; a very common pair is one key of a slice like any
other. A task holds one slice, or one part: some KEYS keys, and those of a hot key, one a slice.
The corpus' counts are never in one place.

Defined cases: a text without words, empty or NULL, has no loss and scores 0. Without target
documents the target is the background and all scores are 0. Rows are scored by themselves, whatever
their doc_id; labels without doc_id are ignored, contradicting labels are averaged. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.llm.common import partitions, rows, sliced, stored, texts

PSEUDO = 20.0  # weight of the unigram model inside the bigram model, in counts
FLOOR = 0.5  # added to each word's count
SLICE = 12 << 20  # bytes of text
KEYS = 1 << 20  # keys added up at once, about
START = 0  # the key of a document's start, which is no word
SHARED_IDS = 4_000_000  # target ids that are given to every task, 8 bytes each


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


class Numbers(dict):
    """Words of a slice to numbers in the order in which they come; 0 starts a document."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


def squeezed(numbers: np.ndarray) -> bytes:
    """64-bit numbers, compressed with the bytes of one place side by side."""
    planes = np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueezed(data: bytes, n: int) -> np.ndarray:
    """The n numbers of squeezed(), as signed ones."""
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data, n * 8, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of pairs from the keys of their words."""
    key = before * np.uint64(0x9E3779B97F4A7C15) + word
    for _ in range(2):
        key = (key ^ (key >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return key ^ (key >> np.uint64(32))


def _marked(docs: DataFrame, target: DataFrame) -> tuple[DataFrame, np.ndarray | None]:
    """Rows of (doc_id, mark, text), and the sorted target ids if the mark is a doc_id to look up.

    Up to SHARED_IDS target ids every task gets them all, so no text is moved. Beyond that the
    mark is a flag that a join sets.
    """
    slim = docs.select(col("doc_id").cast("long").alias("doc_id"), "text")
    target = target.distinct()
    if target.count() <= SHARED_IDS:
        ids = np.sort(target.toArrow()["doc_id"].to_numpy())
        return slim.select("doc_id", col("doc_id").alias("mark"), "text"), ids
    joined = slim.join(target.withColumn("is_target", F.lit(1).cast("long")), "doc_id", "left")
    return joined.select("doc_id", col("is_target").alias("mark"), "text"), None


def _chosen(marks: pa.Array, ids: np.ndarray | None) -> np.ndarray:
    valid = marks.is_valid().to_numpy(zero_copy_only=False)
    if ids is None or not len(ids):
        return valid & (ids is None)
    at = marks.fill_null(0).to_numpy()
    return valid & (ids[np.searchsorted(ids, at).clip(max=len(ids) - 1)] == at)


_SLICES_DDL = (
    "slice long, n_tokens long, n_target long, doc_ids array<long>, "
    "lengths array<int>, marks array<boolean>, n_words int, words binary, tokens binary"
)
_SLICES = pa.schema(
    [
        ("slice", pa.int64()),
        ("n_tokens", pa.int64()),
        ("n_target", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("marks", pa.list_(pa.bool_())),
        ("n_words", pa.int32()),
        ("words", pa.binary()),
        ("tokens", pa.binary()),
    ]
)


def slices(docs: DataFrame, target: DataFrame) -> DataFrame:
    """A row for each slice: its documents in word numbers, and the hashes of the words."""
    rows_in, ids = _marked(docs, target)
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def one(name: int, waiting: list, words: Numbers) -> pa.RecordBatch:
        doc_ids, marks, found = zip(*waiting, strict=True)
        lengths = [len(at) for at in found]
        at = np.concatenate(found)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        n_target = sum(n for n, mark in zip(lengths, marks, strict=True) if mark)
        values = [name, len(at), n_target, doc_ids, lengths, marks, len(words)]
        return rows(_SLICES, [*([v] for v in values), [hashes.tobytes()], [squeezed(at)]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        name = TaskContext.get().partitionId() << 32
        waiting, words, held = [], Numbers(), 0
        for batch in sliced(batches, "text"):
            marks = _chosen(batch.column(1), ids).tolist()
            doc_ids = batch.column(0).to_pylist()
            for doc, mark, text in zip(doc_ids, marks, texts(batch), strict=True):
                some = tokens(text)
                at = np.fromiter(map(words.__getitem__, some), np.int32, len(some))
                waiting.append((doc, mark, at))
                held += len(text)
            if held >= SLICE:
                yield one(name, waiting, words)
                name, waiting, words, held = name + 1, [], Numbers(), 0
        if waiting:
            yield one(name, waiting, words)

    return stored(rows_in.mapInArrow(cut, _SLICES_DDL), "slices")


class Slice:
    """A row of slices() taken apart: the word before each word, distinct pairs, their keys."""

    def __init__(self, row: dict):
        self.doc_ids, self.lengths = row["doc_ids"], np.array(row["lengths"], np.int64)
        self.word = unsqueezed(row["tokens"], row["n_tokens"])
        start = np.array([START], np.uint64)
        self.keys = np.concatenate([start, np.frombuffer(row["words"], "<u8")])
        self.before = np.roll(self.word, 1)
        starts = np.cumsum(self.lengths) - self.lengths
        self.before[starts[self.lengths > 0]] = 0
        self.chosen = np.repeat(np.array(row["marks"], bool), self.lengths)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the words; how often each stands and stands before another, in either model."""
        size = len(self.keys)
        each = (self.word, self.word[self.chosen], self.before, self.before[self.chosen])
        return self.keys, np.array([np.bincount(at, minlength=size) for at in each])

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the distinct pairs, counts in either model, and the pair of each token."""
        size = len(self.keys)
        pair, at = np.unique(self.before * size + self.word, return_inverse=True)
        n = [np.bincount(x, minlength=len(pair)) for x in (at, at[self.chosen])]
        return pair_keys(self.keys[pair // size], self.keys[pair % size]), np.array(n), at


_BLOCKS = pa.schema(
    [
        ("slice", pa.int64()),
        ("part", pa.int32()),
        ("n", pa.int32()),
        ("keys", pa.binary()),
        ("counts", pa.binary()),
    ]
)
_BLOCKS_DDL = "slice long, part int, n int, keys binary, counts binary"
_SUMS = pa.schema(
    [
        ("slice", pa.int64()),
        ("part", pa.int32()),
        ("n", pa.int32()),
        ("distinct", pa.int64()),
        ("sums", pa.binary()),
    ]
)
_SUMS_DDL = "slice long, part int, n int, distinct long, sums binary"


def runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[dict]]:
    """The rows of batches in order, as lists that share a value of the column."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0][column] != row[column]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def summed(
    parts: DataFrame, keyed: Callable[[Slice], tuple], width: int, n_keys: int
) -> DataFrame:
    """For every slice and part of the hash range, the sums over all slices of the slice's keys."""
    n = partitions(parts.sparkSession)
    bits = max(n_keys // KEYS, 2 * n).bit_length()
    bounds = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys, counts = keyed(Slice(row))[:2]
                order = np.argsort(keys)
                keys, counts = keys[order], counts[:, order]
                ends = [*np.searchsorted(keys, bounds).tolist(), len(keys)]
                spans = zip(ends, ends[1:], strict=False)
                found = [(p, a, b) for p, (a, b) in enumerate(spans) if b > a]
                yield rows(
                    _BLOCKS,
                    [
                        [row["slice"]] * len(found),
                        [p for p, _, _ in found],
                        [b - a for _, a, b in found],
                        [squeezed(np.diff(keys[a:b], prepend=bounds[p])) for p, a, b in found],
                        [squeezed(counts[:, a:b]) for _, a, b in found],
                    ],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in runs(batches, "part"):
            bound = bounds[some[0]["part"]]
            keys = np.concatenate(
                [unsqueezed(r["keys"], r["n"]).view("<u8").cumsum() + bound for r in some]
            )
            counts = np.concatenate(
                [unsqueezed(r["counts"], width * r["n"]).reshape(width, -1) for r in some], axis=1
            )
            order = np.argsort(keys)
            keys = keys[order]
            first = np.concatenate([[True], keys[1:] != keys[:-1]])
            totals = np.add.reduceat(counts[:, order], np.flatnonzero(first), axis=1)
            counts[:, order] = totals[:, np.cumsum(first) - 1]
            ends = np.cumsum([r["n"] for r in some])
            distinct = [totals.shape[1]] + [0] * (len(some) - 1)
            for i in range(0, len(some), 1000):
                own = range(i, min(i + 1000, len(some)))
                yield rows(
                    _SUMS,
                    [
                        [some[j]["slice"] for j in own],
                        [some[j]["part"] for j in own],
                        [some[j]["n"] for j in own],
                        [distinct[j] for j in own],
                        [squeezed(counts[:, ends[j] - some[j]["n"] : ends[j]]) for j in own],
                    ],
                )

    return (
        parts.mapInArrow(blocks, _BLOCKS_DDL)
        .repartition(n, "part")
        .sortWithinPartitions("part")
        .mapInArrow(add, _SUMS_DDL)
    )


def losses(counts: np.ndarray, before: np.ndarray, unigram: np.ndarray) -> np.ndarray:
    """-log2 P(word | before) from the counts of pairs, smoothed with the unigram model."""
    return -np.log2((counts + PSEUDO * unigram) / (before + PSEUDO))


def target_ids(labels: DataFrame) -> DataFrame:
    """Documents that the labels call good and not toxic."""
    votes = labels.where("doc_id IS NOT NULL").groupBy(col("doc_id").cast("long").alias("doc_id"))
    return (
        votes.agg(F.avg("quality").alias("quality"), F.avg("toxic").alias("toxic"))
        .where("quality >= 0.5 AND coalesce(toxic, 0) < 0.5")
        .select("doc_id")
    )


_REPORT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("target_loss", pa.float64()),
        ("background_loss", pa.float64()),
        ("score", pa.float64()),
    ]
)
_ROWS_OF_SLICE = ("doc_ids", "lengths", "marks", "n_words", "words", "tokens", "n_tokens")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, n_tokens, the mean losses in bits a word, and their difference."""
    n = partitions(docs.sparkSession)
    parts = slices(docs, target_ids(labels))
    in_all, in_target, in_words = (
        x or 0
        for x in parts.agg(F.sum("n_tokens"), F.sum("n_target"), F.sum("n_words")).first()
    )
    of_words = stored(summed(parts, Slice.words, 4, in_words), "words")
    # A document's start is a key, and no word.
    vocabulary = (of_words.agg(F.sum("distinct")).first()[0] or 1) - 1
    of_pairs = summed(parts, Slice.pairs, 2, in_all)
    scale = in_target / max(in_all, 1) if in_target else 1.0
    total = (in_target or in_all) + FLOOR * vocabulary

    def mean_losses(found: Slice, some: list[dict]) -> list[np.ndarray]:
        def sums(kind: int, keys: np.ndarray, width: int) -> np.ndarray:
            blocks = [r for r in some if r["kind"] == kind]
            got = [unsqueezed(r["sums"], width * r["n"]).reshape(width, -1) for r in blocks]
            out = np.empty((width, len(keys)))
            out[:, np.argsort(keys)] = np.concatenate(got, axis=1)
            return out

        keys, _, at = found.pairs()
        alone, first = np.split(sums(1, found.keys, 4), 2)
        pair = sums(2, keys, 2)
        document = np.repeat(np.arange(len(found.lengths)), found.lengths)
        out = []
        for side, factor in (((1 if in_target else 0), 1.0), (0, scale)):
            unigram = (alone[side] * factor + FLOOR) / total
            each = losses(pair[side][at] * factor, first[side][found.before] * factor,
                          unigram[found.word])
            of_document = np.bincount(document, each, len(found.lengths))
            out.append(of_document / np.maximum(found.lengths, 1))
        return out

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in runs(batches, "slice"):
            found = Slice(some[0])
            if len(found.word):
                target, background = mean_losses(found, some[1:])
            else:
                target = background = np.zeros(len(found.lengths))
            values = [found.doc_ids, found.lengths, target, background, target - background]
            yield rows(_REPORT, values)

    own = parts.select("slice", F.lit(0).alias("kind"), *_ROWS_OF_SLICE)
    answers = [
        df.select("slice", F.lit(kind).alias("kind"), "part", "n", "sums")
        for kind, df in ((1, of_words), (2, of_pairs))
    ]
    return (
        own.unionByName(answers[0], allowMissingColumns=True)
        .unionByName(answers[1], allowMissingColumns=True)
        .repartition(n, "slice")
        .sortWithinPartitions("slice", "kind", "part")
        .mapInArrow(
            score,
            "doc_id long, n_tokens long, target_loss double, background_loss double, "
            "score double",
        )
    )
