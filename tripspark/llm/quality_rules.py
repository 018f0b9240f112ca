"""Quality rules: fixed limits on a document's counts, then boosted trees over its statistics.

Method. A text's counts and ratios are computed in one pass over it. Gradient-boosted trees,
fitted on a bounded sample of labelled documents, are flattened into node arrays, and a batch is
scored by stepping all rows through all trees at once. The score may never rise with the share of
symbols, of duplicate lines or of repeated words.

Defined cases: a NULL or empty text has zero counts and fails the base rule. Rows are judged by
themselves, whatever their doc_id. A document with contradicting labels counts as good if at
least half of its labels do; labels without doc_id or quality are ignored. Without labels of both
kinds only the base rule decides. Extra columns pass through `passing` and are ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.llm import boosting
from tripspark.llm.common import rows, sliced, text_hash, texts
from tripspark.llm.statistics import BASE, FALLING, RATIOS, statistics

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SAMPLE = 8_000  # labelled documents the trees are fitted on, at most
MIN_SCORE = 0.3  # below it the trees reject

_FEATURES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("row_hash", pa.int64()),
        ("label", pa.int32()),
        ("features", pa.list_(pa.float64())),
    ]
)
_REPORT = pa.schema(
    [("doc_id", pa.int64())]
    + [(name, pa.int64()) for name in BASE]
    + [("base_failed", pa.bool_()), ("score", pa.float64()), ("kept", pa.bool_())]
)
_REPORT_DDL = (
    "doc_id long, "
    + ", ".join(f"{name} long" for name in BASE)
    + ", base_failed boolean, score double, kept boolean"
)


def labelled(labels: DataFrame, column: str, sample: int) -> DataFrame:
    """(doc_id, label) of at most `sample` documents, chosen by a hash of their id."""
    votes = labels.where(f"doc_id IS NOT NULL AND {column} IS NOT NULL").groupBy(
        col("doc_id").cast("long").alias("doc_id")
    )
    return (
        votes.agg((F.avg(column) >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> boosting.Forest:
    """Fit the trees. The sample's ids are broadcast: at most `sample` pairs of numbers."""
    chosen = labelled(labels, "quality", sample)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = [statistics(t)[1] for t in texts(batch)]
            yield rows(_FEATURES, [*batch.columns[:3], found])

    found = (
        docs.select(col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", text_hash("text").alias("row_hash"), "label", "text")
        .mapInArrow(features, "doc_id long, row_hash long, label int, features array<double>")
        .orderBy("doc_id", "row_hash")
        .limit(2 * sample)  # only binding where labelled ids repeat in the documents
        .toArrow()
    )
    x = np.array(found["features"].to_pylist(), np.float64).reshape(-1, len(RATIOS))
    y = found["label"].to_numpy().astype(np.float64)
    return boosting.train(x, y, [RATIOS.index(name) for name in FALLING])


def _verdicts(batch: list[bytes], forest: boosting.Forest) -> tuple[np.ndarray, ...]:
    found = [statistics(text) for text in batch]
    base = np.array([b for b, _ in found], np.int64).reshape(-1, len(BASE))
    score = forest.score(np.array([r for _, r in found], np.float64).reshape(-1, len(RATIOS)))
    n_words, repeats = base[:, 0], base[:, 4]
    failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
    return base, failed, score, ~failed & (score >= MIN_SCORE)


def report(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, the trees' score, kept."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            base, failed, score, kept = _verdicts(texts(batch), shared.value)
            yield rows(_REPORT, [batch.column(0), *base.T, failed, score, kept])

    slim = docs.select(col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(judge, _REPORT_DDL)


def passing(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows that the rules keep; all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            kept = _verdicts(texts(batch), shared.value)[3]
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(keep, docs.schema)
