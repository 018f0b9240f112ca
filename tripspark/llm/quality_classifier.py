"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL updates.

Method. Words and word pairs in lower case are hashed into 2**BUCKET_BITS buckets; a document is the
sparse vector of its buckets, of length one, with the roots of the counts. The weights come
from follow-the-regularised-leader updates, one per labelled document and epoch, with per-bucket
learning rates and an L1 term that leaves most weights at zero. Scoring is a sparse dot product.

Training runs in one task over a bounded sample of labelled documents (SAMPLE at most, chosen by
a hash of the id); what reaches the driver is the weight vector of fixed size. Rows whose
crc32(doc_id as text) mod FOLDS is 0 are held out and never trained on.

Defined cases: a NULL or empty text has no n-grams and gets the score of the bias alone. Rows are
scored by themselves, whatever their doc_id; a NULL doc_id is not held out. A document with
contradicting labels counts as good if at least half of its labels do. Without labels of both
kinds every score is the smoothed share of label 1. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.llm.common import rows, sliced, stored, text_hash, texts
from tripspark.llm.quality_rules import labelled

BUCKET_BITS = 20
FOLDS = 5
SAMPLE = 20_000
EPOCHS = 8
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.05, 0.0
THRESHOLD = 0.3


# A word is a run of letters and digits or a run of marks, so that marks stuck to a word count
# as words of their own.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff\x20\x09-\x0d]+")


def buckets(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text's words and word pairs, sorted, and their values: square
    roots of the counts, scaled to length one. All pairs of equal words share a bucket."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    one = np.fromiter(map(xxhash.xxh32_intdigest, words, repeat(7)), np.uint64, len(words))
    pair = (one[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (one[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    pair[one[:-1] == one[1:]] = np.uint64(0xA0761D6478BD642F)
    both = np.concatenate([one * np.uint64(0xD6E8FEB86659FD93), pair])
    found, counts = np.unique(
        (both >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), return_counts=True
    )
    return found, np.sqrt(counts / counts.sum()).astype(np.float32)


def held_out(doc_id: str | Column) -> Column:
    doc = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class Ftrl:
    """Follow-the-regularised-leader state: a row of z and n per bucket, the bias last."""

    def __init__(self, size: int):
        self.z = np.zeros(size)
        self.n = np.zeros(size)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def update(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Weights from (buckets, values, label) examples in order; the bias is the last one."""
    size = 1 << BUCKET_BITS
    state = Ftrl(size + 1)
    good = sum(label for *_, label in examples)
    if not 0 < good < len(examples):
        weights = np.zeros(size + 1)
        weights[-1] = np.log((good + 1) / (len(examples) - good + 1))
        return weights
    for _ in range(EPOCHS):
        for found, values, label in examples:
            state.update(np.append(found, size), np.append(values, 1.0), label)
    return state.weights()


_EXAMPLE_DDL = "doc_id long, row_hash long, label int, buckets binary, values binary"
_EXAMPLE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("row_hash", pa.int64()),
        ("label", pa.int32()),
        ("buckets", pa.binary()),
        ("values", pa.binary()),
    ]
)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The weight vector, from labelled documents that are not held out."""
    chosen = labelled(labels.where(~held_out("doc_id")), "quality", sample)

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = [buckets(t) for t in texts(batch)]
            data = [[b.astype("<i4").tobytes() for b, _ in found]]
            data.append([v.astype("<f4").tobytes() for _, v in found])
            yield rows(_EXAMPLE, [*batch.columns[:3], *data])

    found = (
        docs.select(col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", text_hash("text").alias("row_hash"), "label", "text")
        .mapInArrow(examples, _EXAMPLE_DDL)
    )
    # A bounded number of examples, in an order of their own, in one task.
    order = [F.xxhash64("doc_id", "row_hash"), "doc_id", "row_hash"]
    ordered = stored(found, "examples").orderBy(*order).limit(2 * sample)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [
            (np.frombuffer(found, "<i4"), np.frombuffer(values, "<f4"), label)
            for batch in batches
            for label, found, values in zip(*(c.to_pylist() for c in batch.columns), strict=True)
        ]
        weights = fit(examples).astype("<f4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([weights], pa.binary())], ["weights"])

    one_task = ordered.select("label", "buckets", "values").coalesce(1)
    return np.frombuffer(one_task.mapInArrow(learn, "weights binary").first()["weights"], "<f4")


_REPORT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("score", pa.float64()),
        ("predicted", pa.int32()),
    ]
)


def report(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, held_out, score (probability of label 1), predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in sliced(batches, "text"):
            scores = []
            for text in texts(batch):
                found, values = buckets(text)
                total = float(weights[found] @ values) + float(weights[-1])
                scores.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
            scores = np.array(scores)
            yield rows(
                _REPORT,
                [*batch.columns[:2], scores, (scores >= THRESHOLD).astype(np.int32)],
            )

    return docs.select(
        col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), "text"
    ).mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
