"""Lexical search against a plain scoring of every document and against its SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import pandas as pd
import pytest

from tests.llm.data import collected, docs, edge_rows, prose
from tripspark.llm import lexical_search
from tripspark.llm.queries import QUERIES

COLUMNS = ("item_id", "rank", "doc_id", "score")
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return PATTERN.findall((text or "").translate(LOWER))


def brute(documents, items, top=50):
    bags = [(d, Counter(t)) for d, text in documents if (t := terms(text))]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(terms(text))
    out = []
    for item, vocabulary in wanted.items():
        scored = []
        for doc, bag in bags:
            m = 50 + (50 * bag.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in vocabulary & bag.keys()
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, *_, doc) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def sample():
    rng = random.Random(3)
    documents = edge_rows()
    documents += [(100 + i, " ".join(prose(rng, rng.randrange(1, 80), 60))) for i in range(300)]
    documents += [(1000 - i, "w1 w2, W3-w4 w5") for i in range(120)]  # one large class
    documents += [(2000 + i, f"w1 w2 w3 w4 w5 own{i}") for i in range(60)]  # alike but for a word
    items = [
        (1, "w1 W2 w3 w3"),
        (2, "no such words"),
        (3, None),
        (4, ""),
        (5, " ".join(prose(rng, 40, 60))),
        (5, "w59 漢字"),
        (None, "w7 tie"),
        (7, "w1 w2 w3"),
    ]
    return documents, items


@pytest.mark.parametrize("part_terms", [200_000, 5])
def test_every_score(spark, part_terms):
    documents, items = sample()
    got = lexical_search.report(
        docs(spark, documents, extra=True).repartition(7), table(spark, items), 50, part_terms
    )
    assert collected(got, *COLUMNS) == brute(documents, items)


def test_small_blocks(spark, monkeypatch):
    documents, items = sample()
    found = lexical_search.report(docs(spark, documents), table(spark, items), 3)
    assert collected(found, *COLUMNS) == brute(documents, items, 3)
    best = lexical_search._Best(1, 2)
    monkeypatch.setattr(lexical_search, "CELLS", 5)
    import numpy as np

    blocks = list(lexical_search._blocks(np.array([2, 2, 9, 1]), np.array([0, 1, 2, 3]), 4, 2))
    assert blocks == [(0, 2), (2, 3), (3, 4)]
    assert best.least.tolist() == [1]


def test_nothing_to_find(spark):
    none = docs(spark, [])
    assert lexical_search.report(none, table(spark, [(1, "word")])).collect() == []
    some = docs(spark, [(1, "word"), (2, None)])
    assert lexical_search.report(some, table(spark, [])).collect() == []
    assert lexical_search.report(some, table(spark, [(1, None)])).collect() == []


def test_sql(spark, sf_dir, tmp_path):
    documents, items = sample()
    frame = pd.DataFrame(
        {"doc_id": pd.array([d for d, _ in documents], "Int64"), "text": [t for _, t in documents]}
    )
    asked = pd.DataFrame(
        {"item_id": pd.array([i for i, _ in items], "Int64"), "text": [t for _, t in items]}
    )
    con = duckdb.connect()
    con.register("documents", frame)
    con.register("benchmark", asked)
    assert sorted(con.sql(lexical_search.ORACLE).fetchall(), key=repr) == brute(documents, items)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    got = collected(QUERIES["op12_lexical_search"](spark, sf_dir), *COLUMNS)
    assert got == sorted(con.sql(lexical_search.ORACLE).fetchall(), key=repr)
