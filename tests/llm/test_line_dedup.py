import hashlib
import random
from collections import defaultdict

import pytest

from tests.llm.data import collected, docs, edge_rows, prose
from tripspark.llm import line_dedup
from tripspark.llm.common import SPACE

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, min_chars=40, min_docs=5):
    def key(line):
        return line.strip(SPACE).translate(LOWER)

    holders = defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= min_chars:
                    holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if doc is None
            or len(holders.get(key(line), ())) < min_docs
            or max(holders[key(line)]) == doc
        ]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def check(spark, rows):
    got = collected(
        line_dedup.line_report(docs(spark, rows)), "doc_id", "n_lines", "n_dropped", "kept_sha256"
    )
    want = [
        (d, n, dropped, hashlib.sha256(kept.encode()).hexdigest()) for d, n, dropped, kept in brute(rows)
    ]
    assert got == sorted(want, key=repr)


def test_edges(spark):
    check(spark, edge_rows())


def test_hot_lines_span_partitions(spark):
    """Half of all documents share one line; others are shared by 2 to 12 documents."""
    rng = random.Random(1)
    common = " ".join(prose(rng, 12))
    shared = [" ".join(prose(rng, 12)) for _ in range(60)]
    rows = []
    for doc in range(600):
        lines = [" ".join(prose(rng, 10)) for _ in range(3)]
        if doc % 2:
            lines += [common, common.upper()]
        lines += rng.sample(shared, rng.randrange(3))
        rng.shuffle(lines)
        rows.append((doc, "\n".join(lines)))
    check(spark, rows)


def test_every_line_is_shared(spark):
    line = "x" * 39
    check(spark, [(i, f"{line}\n{line}y\n{line}y") for i in range(50)])
    check(spark, [(i, f"{line}\n{line}y") for i in range(4)])


@pytest.mark.parametrize("extra", [False, True])
def test_filter_keeps_columns(spark, extra):
    rows = edge_rows()
    df = docs(spark, rows, extra)
    out = line_dedup.without_shared_lines(df)
    assert out.schema == df.schema
    want = [
        (doc, text if dropped == 0 else kept, "en")
        for (doc, text), (_, _, dropped, kept) in zip(rows, brute(rows), strict=True)
    ]
    assert collected(out, "doc_id", "text", "lang") == sorted(want, key=repr)


def test_bitmaps(spark):
    rows = edge_rows()
    maps = line_dedup.keep_bitmaps(docs(spark, rows)).collect()
    assert {(m["doc_id"], m["n_dropped"]) for m in maps} == {
        (d, n) for d, _, n, _ in brute(rows) if n
    }
    text = dict(r for r in rows if r[0] == 20)[20]
    mine = next(m for m in maps if m["doc_id"] == 20)
    assert line_dedup.kept_text(text.encode(), mine["bitmap"]) == text.replace(
        text.split("\n")[1] + "\n", ""
    ).encode()


def test_empty(spark):
    df = docs(spark, [])
    assert line_dedup.line_report(df).collect() == []
    assert line_dedup.without_shared_lines(df).collect() == []
