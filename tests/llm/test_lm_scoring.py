import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.data import docs, edge_rows, prose
from tripspark.llm import lm_scoring
from tripspark.llm.lm_scoring import FLOOR, PSEUDO, squeezed, tokens, unsqueezed


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def brute(rows, target):
    """Scores from plain dictionaries over all words."""

    def pairs(text):
        at = ["", *tokens((text or "").encode())]
        return list(zip(at, at[1:], strict=False))

    both = [Counter(), Counter()]
    for doc, text in rows:
        both[0].update(pairs(text))
        if doc in target:
            both[1].update(pairs(text))
    if not both[1]:
        both[1] = both[0]
    size = len({word for _, word in both[0]})
    scale = [sum(both[1].values()) / max(sum(both[0].values()), 1), 1.0]
    models = []
    for side in (0, 1):
        pair = {k: n * scale[side] for k, n in both[side].items()}
        word, before = Counter(), Counter()
        for (a, b), n in pair.items():
            before[a] += n
            word[b] += n
        total = sum(word.values()) + FLOOR * size
        models.append((pair, word, before, total))

    def loss(side, a, b):
        pair, word, before, total = models[side]
        one = (word[b] + FLOOR) / total
        return -math.log2((pair.get((a, b), 0) + PSEUDO * one) / (before[a] + PSEUDO))

    out = []
    for doc, text in rows:
        found = pairs(text)
        losses = [
            sum(loss(s, a, b) for a, b in found) / len(found) if found else 0.0 for s in (1, 0)
        ]
        out.append((doc, len(found), *losses, losses[0] - losses[1]))
    return out


def agree(got, want):
    got, want = (sorted(x, key=lambda r: (repr(r[0]), r[1:])) for x in (map(tuple, got), want))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2:] for g in got], [w[2:] for w in want], atol=1e-9)


@pytest.mark.parametrize(("vocabulary", "shared"), [(5, 10**6), (50, 10**6), (50, 0)])
def test_scores(spark, monkeypatch, vocabulary, shared):
    monkeypatch.setattr(lm_scoring, "SHARED_IDS", shared)
    rng = random.Random(1)
    rows = edge_rows() + [(100 + i, " ".join(prose(rng, 50 + i, vocabulary))) for i in range(20)]
    marks = [(100 + i, i % 2, 0) for i in range(20)] + [(103, 1, 1), (None, 1, 0), (105, 1, None)]
    got = lm_scoring.report(docs(spark, rows, extra=True), labels(spark, marks)).collect()
    # 103 is as often toxic as not and does not count.
    agree(got, brute(rows, {100 + i for i in range(20) if i % 2} - {103}))


def test_target_like_documents_score_lower(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(prose(rng, 80, 50) if i % 2 else [f"x{w}" for w in prose(rng, 80, 50)]))
            for i in range(80)]
    marks = [(i, i % 2, 0) for i in range(40)]
    score = {r["doc_id"]: r["score"] for r in
             lm_scoring.report(docs(spark, rows), labels(spark, marks)).collect()}
    assert max(score[i] for i in range(41, 80, 2)) < min(score[i] for i in range(40, 80, 2))


def test_every_word_counts(spark, monkeypatch):
    """Many slices and parts, most words rare: losses are those of the words."""
    monkeypatch.setattr(lm_scoring, "SLICE", 4_000)
    monkeypatch.setattr(lm_scoring, "KEYS", 100)
    rng = random.Random(3)
    rows = edge_rows() + [(100 + i, " ".join(prose(rng, 100, 20_000))) for i in range(60)]
    marks = [(100 + i, i % 2, 0) for i in range(60)]
    assert len({w for _, t in rows for w in (t or "").lower().split()}) > 2048
    got = lm_scoring.report(docs(spark, rows), labels(spark, marks)).collect()
    agree(got, brute(rows, {101 + i for i in range(0, 60, 2)}))


def test_common_pair_in_every_slice(spark, monkeypatch):
    """A third of all pairs are one pair, which every slice holds."""
    monkeypatch.setattr(lm_scoring, "SLICE", 500)
    rng = random.Random(4)
    rows = [(i, " ".join(["of the"] * 20 + prose(rng, 80, 200))) for i in range(60)]
    marks = [(i, i % 3 == 0, 0) for i in range(60)]
    got = lm_scoring.report(docs(spark, rows), labels(spark, [(i, int(q), t) for i, q, t in marks]))
    agree(got.collect(), brute(rows, set(range(0, 60, 3))))


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_squeezed_numbers_come_back(n):
    rng = np.random.default_rng(n)
    for high in (2, 1 << 20, (1 << 63) - 1):
        numbers = rng.integers(0, high, n)
        assert (unsqueezed(squeezed(numbers), n) == numbers).all()


def test_documents_without_words_only(spark):
    rows = [(1, None), (2, ""), (None, " \n")]
    out = lm_scoring.report(docs(spark, rows), labels(spark, [(1, 1, 0)])).collect()
    agree(out, [(doc, 0, 0.0, 0.0, 0.0) for doc, _ in rows])


def test_without_target_or_documents(spark):
    rows = edge_rows()
    out = lm_scoring.report(docs(spark, rows), labels(spark, [])).collect()
    assert len(out) == len(rows) and {round(r["score"], 6) for r in out} == {0.0}
    assert lm_scoring.report(docs(spark, []), labels(spark, [])).collect() == []
