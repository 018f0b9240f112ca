import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.data import collected, docs, edge_rows, prose
from tripspark.llm import boosting, quality_classifier, quality_rules
from tripspark.llm.statistics import BASE, FALLING, RATIOS, statistics

SPACE = " \t\n\x0b\x0c\r"


def brute(text):
    text = text or ""
    for c in SPACE:
        words = text.replace(c, " ") if c == SPACE[0] else words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    repeated = {
        i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)
    }
    earlier, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            dup += line in earlier
            earlier.add(line)
    return [
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        dup,
        len(repeated),
    ]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def odd_texts():
    rng = random.Random(9)
    part = " ".join(prose(rng, 12))
    return [
        "a b c d e f g h a b c d e f g h",
        "a a a a a a a a a",
        "a a a a a a a a",
        f"{part} x {part} y {part}",
        "l1 x\n\n \nl1 x\nl1 x \nl2",
        "##**$$ %%&& ||<> é ü",
    ]


def test_counts():
    for text in [t for _, t in edge_rows()] + odd_texts():
        assert statistics((text or "").encode())[0] == brute(text)


def junk(rng):
    return " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in prose(rng, 120, 300))


def labelled_docs(n=300):
    rng = random.Random(11)
    rows, marks = [], []
    for i in range(n):
        bad = i % 4 == 0
        rows.append((i, junk(rng) if bad else " ".join(prose(rng, 120, 300))))
        marks.append((i, int(not bad), 0))
    return rows, marks


def test_rules(spark):
    rows, marks = labelled_docs()
    rows += [(1000 + i, t) for i, (_, t) in enumerate(edge_rows())]
    rows += [(2000 + i, t) for i, t in enumerate(odd_texts())]
    marks += [(None, 1, 0), (5, None, 0), (5, 1, 0), (77_777, 0, 0)]
    df = docs(spark, rows, extra=True)
    out = quality_rules.report(df, labels(spark, marks))
    want = []
    for doc, text in rows:
        base = brute(text)
        want.append((doc, *base, base[0] < 20 or 100 * base[4] > 30 * base[0]))
    assert collected(out, "doc_id", *BASE, "base_failed") == sorted(want, key=repr)
    for r in out.collect():
        assert not (r["base_failed"] and r["kept"])
        if r["doc_id"] < 300:
            assert r["kept"] == (r["doc_id"] % 4 != 0)
    kept = {r["doc_id"] for r in out.collect() if r["kept"]}
    passing = quality_rules.passing(df, labels(spark, marks))
    assert passing.schema == df.schema
    assert {r["doc_id"] for r in passing.collect()} == kept


@pytest.mark.parametrize("marks", [[], [(1, 1, 0), (2, 1, 0)], [(1, 0, 0)]])
def test_rules_without_both_labels(spark, marks):
    rows = [(1, " ".join(prose(random.Random(1), 50))), (2, "short"), (None, None)]
    kept = collected(quality_rules.report(docs(spark, rows), labels(spark, marks)), "doc_id", "kept")
    assert kept == sorted([(1, True), (2, False), (None, False)], key=repr) or marks[0][1] == 0


def test_rules_on_empty_tables(spark):
    assert quality_rules.report(docs(spark, []), labels(spark, [])).collect() == []
    assert quality_rules.passing(docs(spark, []), labels(spark, [])).collect() == []


def test_forest_is_monotone_and_flat():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 4))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=800) * 0.3 < 0).astype(float)
    forest = boosting.train(x, y, [0])
    assert ((forest.score(x) > 0.5) == (y > 0.5)).mean() > 0.9
    grid = np.linspace(-3, 3, 41)
    for row in x[:60]:
        line = np.tile(row, (41, 1))
        line[:, 0] = grid
        assert (np.diff(forest.score(line)) <= 1e-12).all()

    def walk(row):
        total = forest.prior
        for node in forest.roots:
            while forest.feature[node] >= 0:
                low = row[forest.feature[node]] <= forest.threshold[node]
                node = forest.left[node] if low else forest.right[node]
            total += forest.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.score(x[:50]), [walk(r) for r in x[:50]])


def test_features_are_named():
    base, ratios = statistics(b"some words")
    assert len(base) == len(BASE) and len(ratios) == len(RATIOS)
    assert set(FALLING) <= set(RATIOS)


# --- classifier -----------------------------------------------------------------------


def crc_fold(doc):
    import zlib

    return zlib.crc32(str(doc).encode()) % 5


def test_classifier(spark):
    rows, marks = labelled_docs(400)
    rows += [(1000, None), (1001, ""), (None, "words"), (1002, "word")]
    out = quality_classifier.report(docs(spark, rows, extra=True), labels(spark, marks)).collect()
    assert len(out) == len(rows)
    right = total = 0
    for r in out:
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.3)
        if r["doc_id"] is None:
            assert not r["held_out"]
            continue
        assert r["held_out"] == (crc_fold(r["doc_id"]) == 0)
        if r["held_out"] and r["doc_id"] < 400:
            total += 1
            right += r["predicted"] == (r["doc_id"] % 4 != 0)
    assert total > 40 and right / total > 0.9


def test_held_out_labels_do_not_matter(spark):
    rows, marks = labelled_docs(200)
    turned = [(i, 1 - q, t) if crc_fold(i) == 0 else (i, q, t) for i, q, t in marks]
    df = docs(spark, rows)
    a = collected(quality_classifier.report(df, labels(spark, marks)), "doc_id", "score")
    b = collected(quality_classifier.report(df, labels(spark, turned)), "doc_id", "score")
    assert a == b


@pytest.mark.parametrize("marks", [[], [(1, 1, 0), (2, 1, 0)]])
def test_classifier_without_both_labels(spark, marks):
    df = docs(spark, [(1, "a b"), (2, None)])
    scores = {r["score"] for r in quality_classifier.report(df, labels(spark, marks)).collect()}
    assert len(scores) == 1
    assert quality_classifier.report(docs(spark, []), labels(spark, marks)).collect() == []


def test_ftrl_update_by_hand():
    state = quality_classifier.Ftrl(3)
    at, value = np.array([0, 2]), np.array([0.5, 1.0])
    state.update(at, value, 1.0)
    g = -0.5 * value
    assert np.allclose(state.z[at], g) and np.allclose(state.n[at], g * g)
    w = state.weights(at)
    alpha, beta, l1, l2 = (
        quality_classifier.ALPHA, quality_classifier.BETA, quality_classifier.L1, quality_classifier.L2
    )
    assert np.allclose(w, -(g + l1) / ((beta + np.abs(g)) / alpha + l2))
