"""Approximate nearest neighbours by shifted space-filling curves.

Method. Several times the vectors are projected onto a few random orthonormal directions; each
coordinate is replaced by its quantile, shifted at random and laid on a grid, and the cells are
numbered along a Hilbert curve. Each such ordering is range-partitioned by the curve's key, which
ranks every vector. A query's candidates in an ordering are the vectors within a window of ranks
around its own. The ranks are cut into blocks of bounded size; a block meets the queries whose
windows touch it, distances are taken in double precision on the original vectors, and the
nearest of all orderings and blocks are merged.

The window is fitted, not set: for a bounded sample of queries (`SAMPLE`) the true neighbours are
found among all vectors, and the window is made so wide that `TARGET` of them lie in it in one
ordering at least. Where vectors have structure it is narrow; where they have none, as with
independent directions, it is a fixed share of the vectors. Every vector is in every ordering.

Equal vectors are one class: it is searched once and stands for its members, of which only the
k + 1 smallest vec_ids can be wanted. So a vector that a third of the rows hold is one point.

Defined cases: vectors that are NULL, zero or hold NULL or non-finite components take no part, as
candidates or as queries, nor do rows without vec_id. A shorter vector counts as padded with
zeros. Rows equal in vec_id and vector are one row; another vector under the same vec_id is a
candidate and a query of its own, and a query never finds its own vec_id. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.llm.common import partitions, rows, stored

K = 10
EVERY = 100  # queries are the vec_ids divisible by this
ORDERINGS = 8
DIRECTIONS = 6
BITS = 10  # of the grid in each direction; DIRECTIONS * BITS bits make a key
SAMPLE = 128  # queries that fit the window
SAMPLE_VALUES = 500_000  # numbers that fit the quantiles: some thousand vectors
TARGET = 0.97
BLOCK_BYTES = 4 << 20  # of the vectors of a block, as doubles

_KEYS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("keys", pa.list_(pa.int64()))])
_NEAR = pa.schema(
    [
        ("qa", pa.int64()),
        ("qb", pa.int64()),
        ("d", pa.float64()),
        ("a", pa.int64()),
        ("b", pa.int64()),
    ]
)
_NEAR_DDL = "qa long, qb long, d double, a long, b long"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of grid cells along the Hilbert curve.

    `cells` has a row per point, values below 2**bits. Skilling's transposition, for all points
    at once.
    """
    x = cells.T.astype(np.int64)
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= flips
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> level) & 1
    return key


class Curves:
    """The orderings: directions, quantiles and shifts, from a sample of vectors."""

    def __init__(self, sample: np.ndarray, orderings: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        n = min(DIRECTIONS, dim)
        self.bits = BITS
        self.directions = [
            np.linalg.qr(rng.normal(size=(dim, n)))[0] for _ in range(orderings)
        ]
        self.quantiles = [np.sort(sample @ d, axis=0) for d in self.directions]
        self.shifts = [rng.uniform(0, 1, n) for _ in range(orderings)]

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """A column of curve keys per ordering."""
        out = []
        for directions, quantiles, shift in zip(
            self.directions, self.quantiles, self.shifts, strict=True
        ):
            at = vectors @ directions
            place = np.column_stack(
                [np.searchsorted(q, c) / len(q) for q, c in zip(quantiles.T, at.T, strict=True)]
            )
            cells = ((place + shift) / 2 * (1 << self.bits)).astype(np.int64)
            out.append(hilbert_keys(np.minimum(cells, (1 << self.bits) - 1), self.bits))
        return np.column_stack(out)


def _matrix(batch: pa.RecordBatch, column: int, dim: int) -> np.ndarray:
    """The vectors of a batch as doubles, padded with zeros."""
    values = batch.column(column)
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = values.value_lengths().to_numpy()
    if (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim))
    out[np.arange(dim)[None] < lengths[:, None]] = flat
    return out


def _distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    apart = vectors - query
    return np.sqrt((apart * apart).sum(axis=1))


def _nearest(distance: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Places of the k nearest, ties by the smaller vec_id."""
    if len(distance) <= k:
        return np.arange(len(distance))
    within = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
    return within[np.lexsort((first[within], distance[within]))[:k]]


def _near_rows(query: tuple, distance: np.ndarray, a, b, at: np.ndarray) -> pa.RecordBatch:
    n = len(at)
    return rows(_NEAR, [[query[0]] * n, [query[1]] * n, distance[at], a[at], b[at]])


def _taking_part(embeddings: DataFrame) -> DataFrame:
    """(vec_id, a, b, vector): the rows that take part, each once, with the hash of its vector."""
    vector = col("embedding")
    valid = embeddings.where(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
        & col("vec_id").isNotNull()
    )
    unsigned = F.transform(vector, lambda x: F.when(x == 0, F.abs(x)).otherwise(x))  # no -0.0
    return (
        valid.select(col("vec_id").cast("long").alias("vec_id"), unsigned.alias("vector"))
        .withColumn("a", F.xxhash64("vector"))
        .withColumn("b", F.xxhash64(F.lit(1), "vector"))
        .groupBy("vec_id", "a", "b")
        .agg(F.first("vector").alias("vector"))
    )


def _classes(members: DataFrame, n: int) -> DataFrame:
    """Distinct vectors with their n smallest vec_ids."""
    alike = Window.partitionBy("a", "b", "vector").orderBy("vec_id")
    return (
        members.withColumn("k", F.row_number().over(alike))
        .where(col("k") <= n)
        .groupBy("a", "b", "vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )


def _collected(vectors: DataFrame, dim: int) -> np.ndarray:
    """A bounded number of vectors on the driver."""
    found = vectors.select("vector").toArrow()
    parts = [_matrix(b, 0, dim) for b in found.to_batches()]
    return np.concatenate([np.empty((0, dim)), *parts])


def _ranked(classes: DataFrame, curves, dim: int, n: int) -> DataFrame:
    """(a, b, ordering, rank): the place of every vector in every ordering, from 0."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = curves.value.keys(_matrix(batch, 2, dim))
            yield rows(_KEYS, [batch.column(0), batch.column(1), list(found)])

    order = ["ordering", "key", "a", "b"]
    placed = stored(
        classes.select("a", "b", "vector")
        .mapInArrow(keys, "a long, b long, keys array<long>")
        .select("a", "b", F.posexplode("keys").alias("ordering", "key"))
        .repartitionByRange(partitions(classes.sparkSession), *order)
        .sortWithinPartitions(*order)
        # The id numbers the rows of a partition from 0 below its upper bits.
        .withColumn("id", F.monotonically_increasing_id())
        .select(
            "a",
            "b",
            "ordering",
            F.shiftright("id", 33).alias("part"),
            col("id").bitwiseAND((1 << 33) - 1).alias("place"),
        ),
        "orderings",
    )
    # A row per partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = col("start") + col("place") - col("ordering") * F.lit(n)
    return placed.join(F.broadcast(starts), "part").select("a", "b", "ordering", rank.alias("rank"))


def _true_neighbours(classes: DataFrame, queries: list, dim: int, k: int) -> DataFrame:
    """The k nearest other classes of a bounded list of queries, by a pass over all vectors."""
    asked = classes.sparkSession.sparkContext.broadcast(queries)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, first = (batch.column(i).to_numpy() for i in range(3))
            vectors = _matrix(batch, 3, dim)
            for qa, qb, query in asked.value:
                distance = _distances(vectors, np.array(query))
                distance[(a == qa) & (b == qb)] = np.inf
                at = _nearest(distance, first, k)
                yield _near_rows((qa, qb), distance, a, b, at[distance[at] < np.inf])

    nearest = Window.partitionBy("qa", "qb").orderBy("d", "a", "b")
    return (
        classes.select("a", "b", col("ids")[0], "vector")
        .mapInArrow(scan, _NEAR_DDL)
        .withColumn("k", F.row_number().over(nearest))
        .where(col("k") <= k)
        .select("qa", "qb", "a", "b")
    )


def _window(ranked: DataFrame, truth: DataFrame, target: float, least: int) -> int:
    """The half width in ranks that holds `target` of the true pairs in some ordering."""
    truth = F.broadcast(truth)  # SAMPLE * k rows
    asked = F.broadcast(truth.select("qa", "qb").distinct())
    on = (col("a") == col("qa")) & (col("b") == col("qb"))
    own = ranked.join(asked, on).select("qa", "qb", "ordering", col("rank").alias("own"))
    gaps = (
        ranked.join(truth, ["a", "b"])
        .join(F.broadcast(own), ["qa", "qb", "ordering"])
        .groupBy("qa", "qb", "a", "b")
        .agg(F.min(F.abs(col("rank") - col("own"))).alias("gap"))
    )
    found = [r.gap for r in gaps.select("gap").collect()]
    return max(least, int(np.quantile(found, target, method="higher")) if found else 0)


def _windows_searched(window: int, dim: int, k: int):
    """Blocks meet the queries that touch them; sorted so that a block's vectors come first."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, points = None, [], None
        for batch in batches:
            ordering, number, asks, rank, a, b, first = (
                batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)
            )
            vectors = _matrix(batch, 7, dim)
            new = np.flatnonzero(
                (np.diff(ordering) != 0) | (np.diff(number) != 0) | (np.diff(asks) != 0)
            )
            for lo, hi in zip([0, *(new + 1)], [*(new + 1), len(rank)], strict=True):
                if (ordering[lo], number[lo]) != block:
                    block, parts, points = (ordering[lo], number[lo]), [], None
                if not asks[lo]:
                    parts.append((rank[lo:hi], a[lo:hi], b[lo:hi], first[lo:hi], vectors[lo:hi]))
                    continue
                if points is None:
                    points = [np.concatenate(c) for c in zip(*parts, strict=True)]
                    order = np.argsort(points[0])
                    points = [c[order] for c in points]
                at = points[0]
                for i in range(lo, hi):
                    begin, end = np.searchsorted(at, [rank[i] - window, rank[i] + window + 1])
                    _, near_a, near_b, near_first, near = (c[begin:end] for c in points)
                    distance = _distances(near, vectors[i])
                    best = _nearest(distance, near_first, k)
                    yield _near_rows((a[i], b[i]), distance, near_a, near_b, best)

    return search


def report(
    embeddings: DataFrame,
    k: int = K,
    every: int = EVERY,
    orderings: int = ORDERINGS,
    sample: int = SAMPLE,
    target: float = TARGET,
) -> DataFrame:
    """Per query its k nearest found: query_id, rank, vec_id, score (the distance)."""
    spark = embeddings.sparkSession
    members = stored(_taking_part(embeddings), "vectors")
    asked = members.where(col("vec_id") % every == 0)
    classes = stored(_classes(members, k + 1), "classes")
    n, dim = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    fitted = classes.orderBy(F.xxhash64("a"), "b").limit(max(64, SAMPLE_VALUES // dim))
    curves = spark.sparkContext.broadcast(Curves(_collected(fitted, dim), orderings))
    ranked = _ranked(classes, curves, dim, n)
    questions = stored(classes.join(asked.select("a", "b").distinct(), ["a", "b"]), "questions")
    some = questions.orderBy(F.xxhash64("b"), "a").limit(sample)
    some = some.select("a", "b", "vector").collect()
    padded = [(r.a, r.b, r.vector + [0.0] * (dim - len(r.vector))) for r in some]
    truth = stored(_true_neighbours(classes, padded, dim, k), "truth")
    window = _window(ranked, truth, target, k)

    size = max(k, BLOCK_BYTES // (8 * dim))
    places = ranked.groupBy("a", "b").agg(F.collect_list(F.struct("ordering", "rank")).alias("at"))
    placed = stored(classes.join(places, ["a", "b"]), "placed")
    columns = ["a", "b", col("ids")[0].alias("first"), "vector", F.inline("at")]
    points = placed.select(*columns).selectExpr("*", f"rank div {size} AS block", "0 AS asks")
    queries = (
        placed.join(questions.select("a", "b"), ["a", "b"])
        .select(*columns)
        .selectExpr(
            "*",
            f"explode(sequence(greatest(rank - {window}, 0) div {size},"
            f" least(rank + {window}, {n - 1}) div {size})) AS block",
            "1 AS asks",
        )
    )
    found = (
        points.unionByName(queries)
        .select("ordering", "block", "asks", "rank", "a", "b", "first", "vector")
        .repartition("ordering", "block")
        .sortWithinPartitions("ordering", "block", "asks")
        .mapInArrow(_windows_searched(window, dim, k + 1), _NEAR_DDL)
    )
    merged = found.groupBy("qa", "qb", "a", "b").agg(F.min("d").alias("d"))
    named = stored(merged, "found").join(classes.select("a", "b", "ids"), ["a", "b"])
    nearest = Window.partitionBy("qa", "qb").orderBy("d", col("ids")[0], "a", "b")
    own = (col("a") == col("qa")) & (col("b") == col("qb"))
    near = (
        named.withColumn("k", F.row_number().over(nearest))
        .where(col("k") <= k + 1)
        .select("qa", "qb", "d", own.alias("own"), F.explode("ids").alias("vec_id"))
        .groupBy(col("qa").alias("a"), col("qb").alias("b"))
        # At most (k + 1) ** 2 rows of a query.
        .agg(F.sort_array(F.collect_list(F.struct("d", "vec_id", "own"))).alias("near"))
    )
    answered = asked.select("a", "b", col("vec_id").alias("query_id")).join(near, ["a", "b"])
    return (
        answered.select(
            "query_id",
            F.posexplode(
                F.slice(F.expr("filter(near, x -> NOT (x.own AND x.vec_id = query_id))"), 1, k)
            ).alias("place", "near"),
        )
        .select(
            "query_id",
            (col("place") + 1).alias("rank"),
            col("near.vec_id").alias("vec_id"),
            col("near.d").alias("score"),
        )
    )
