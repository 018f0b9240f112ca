"""Approximate neighbours: the curve, recall and exact distances against brute force, edge cases."""

import numpy as np
import pytest

from tests.llm.data import collected
from tripspark.llm import neighbours
from tripspark.llm.common import read
from tripspark.llm.queries import QUERIES

DDL = "vec_id long, embedding array<float>, label int"


def brute(pairs, k=10, every=100):
    """{query_id: [(distance, vec_id)]} of (vec_id, vector) pairs."""
    ids = np.array([i for i, _ in pairs])
    vectors = np.array([v for _, v in pairs], np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        apart = vectors - vectors[i]
        distance = np.sqrt((apart * apart).sum(axis=1))
        order = [j for j in np.lexsort((ids, distance)) if j != i][:k]
        out[int(ids[i])] = [(float(distance[j]), int(ids[j])) for j in order]
    return out


def answers(df):
    out = {}
    for query, rank, vec_id, score in collected(df, "query_id", "rank", "vec_id", "score"):
        out.setdefault(query, {})[rank] = (score, vec_id)
    assert all(sorted(o) == list(range(1, len(o) + 1)) for o in out.values())
    return {q: [o[r] for r in sorted(o)] for q, o in out.items()}


def recall(got, want):
    hits = sum(len({v for _, v in want[q]} & {v for _, v in got.get(q, [])}) for q in want)
    return hits / sum(len(w) for w in want.values())


def clustered(rng, n, dim=16):
    centres = rng.normal(size=(40, dim)) * 5
    return [(i, centres[rng.integers(40)] + rng.normal(size=dim)) for i in range(n)]


@pytest.mark.parametrize("n,bits", [(1, 5), (2, 4), (3, 3), (6, 2)])
def test_curve_visits_neighbours(n, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    keys = neighbours.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(1 << bits * n))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_recall_and_distances(spark):
    pairs = clustered(np.random.default_rng(1), 4000)
    df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in pairs], DDL)
    got, want = answers(neighbours.report(df)), brute(pairs)
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.95
    exact = {q: dict((v, d) for d, v in w) for q, w in brute(pairs, k=3999).items()}
    for query, near in got.items():
        assert near == sorted(near) and len(near) == 10
        assert all(exact[query][v] == d for d, v in near)


def test_window_is_narrow_where_vectors_have_structure(spark, monkeypatch):
    widths = []
    fitted = neighbours._window
    monkeypatch.setattr(
        neighbours, "_window", lambda *a: widths.append(fitted(*a)) or widths[-1]
    )
    line = [(i, [float(i), float(i % 7) / 10, 0.0]) for i in range(3000)]
    df = spark.createDataFrame([(i, [x + 1 for x in v], 0) for i, v in line], DDL)
    got = answers(neighbours.report(df))
    assert recall(got, brute(line)) >= 0.95
    assert widths[0] <= 60


def test_whole_table(spark, sf_dir):
    pairs = [(r.vec_id, r.embedding) for r in read(spark, sf_dir, "embeddings").collect()]
    got = answers(QUERIES["op13_neighbours"](spark, sf_dir))
    want = brute(pairs)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9


def test_a_vector_many_rows_hold(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 1000)
    rng = np.random.default_rng(2)
    pairs = clustered(rng, 600, 4) + [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(600, 1000)]
    df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in pairs], DDL)
    got, want = answers(neighbours.report(df.union(df.limit(500)).repartition(9))), brute(pairs)
    for query in (600, 700, 800, 900):
        assert got[query] == want[query]
    assert recall(got, want) >= 0.95


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0], 1),
        (0, [1.0, 0.0, 0.0], 1),  # the same row again
        (100, [0.0, 2.0], 1),  # shorter: padded
        (100, [3.0, 0.0, 0.0], 1),  # the id again, with another vector
        (1, [1.0, 0.0, 0.0], None),
        (2, [1.0, -0.0, 0.0], 1),
        (3, None, 1),
        (4, [], 1),
        (5, [0.0, 0.0, 0.0], 1),
        (6, [1.0, None, 0.0], 1),
        (7, [1.0, nan, 0.0], 1),
        (8, [1.0, -inf, 0.0], 1),
        (200, [nan, 1.0, 1.0], 1),
        (None, [1.0, 1.0, 1.0], 1),
    ]
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "vec_id AS a", "label AS rank")
    got = collected(neighbours.report(df), "query_id", "rank", "vec_id", "score")
    root5, root13 = float(np.sqrt(5.0)), float(np.sqrt(13.0))
    assert got == sorted(
        [
            (0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 100, 2.0), (0, 4, 100, root5),
            # the shorter vector as a query, then the one on the first axis
            (100, 1, 0, root5), (100, 2, 1, root5), (100, 3, 2, root5), (100, 4, 100, root13),
            (100, 1, 0, 2.0), (100, 2, 1, 2.0), (100, 3, 2, 2.0), (100, 4, 100, root13),
        ],
        key=repr,
    )
    assert neighbours.report(df.where("vec_id IS NULL")).collect() == []
    assert neighbours.report(df.where("vec_id = 1")).collect() == []
    assert neighbours.report(df.where("vec_id = 0")).collect() == []
