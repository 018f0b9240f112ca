"""The prefix trie against plain Python and its SQL, with shards, spills and long conversations."""

import hashlib
import random
import re
import zlib

import duckdb
import pandas as pd
import pytest

from tests.llm.data import collected
from tripspark.llm import prefix_trie
from tripspark.llm.common import read
from tripspark.llm.queries import QUERIES

COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
)
DDL = "conv_id long, turn long, role string, text string"


def order(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    md5 = [hashlib.md5(t.encode()).hexdigest() for t in (role, text)]
    return (turn is not None, turn or 0, role[:64], text[:64], *md5)


def brute(turns):
    own = {}
    for row in sorted((r for r in turns if r[0] is not None), key=order):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    members = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt = tuple(own.get(c - c % 20, [])[:h] + mine[h:])
        for d in range(len(rebuilt) + 1):
            members.setdefault(rebuilt[:d], []).append((c, len(rebuilt)))
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    totals = {}
    for prefix in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        below = [totals[c] for c in children.get(prefix, [])]
        totals[prefix] = (
            sum(b[0] for b in below) or 1,
            sum(b[1] for b in below) + (len(members[prefix]) - 1) * words,
        )
    out = []
    for prefix, mine in members.items():
        ends = ",".join(str(c) for c, n in sorted(mine) if n == len(prefix))
        out.append(
            (
                min(mine)[0],
                len(prefix),
                min(members[prefix[:-1]])[0] if prefix else None,
                len(mine),
                len(children.get(prefix, [])),
                *totals[prefix],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def bushy(rng, n, depth=9):
    """Conversations of few different turns, so that they share many openings."""
    out = []
    for c in range(n):
        for t in range(rng.randrange(1, depth)):
            words = " ".join(["word"] * rng.randrange(1, 3))
            out.append((c, t, ("user", "assistant")[t % 2], f"{rng.randrange(2)} {words}"))
    return out


def awkward():
    rng = random.Random(8)
    rows = bushy(rng, 90)
    rows += [(500 + i, t, "user", f"same {t}\tturn\x0b of\x1call") for i in range(60) for t in range(5)]
    rows += [(100, t, "user", f"long {t % 5}") for t in range(700)]  # most rows of one id
    rows += [(101, t, "user", f"long {t % 5}") for t in range(690)]
    rows += [(700, None, None, None), (700, None, "", ""), (700, 0, "user", None)]
    rows += [(701, 3, "user", "tie"), (701, 3, "user", "tie"), (701, 3, "assistant", "tie b")]
    rows += [(701, 3, None, "x" * 70 + end) for end in "ba"]
    rows += [(None, 1, "user", "nobody's turn"), (721, 0, "user", "base is absent")]
    rows += [(740, 0, "user", "deep " * 20_000), (741, 0, "user", "deep " * 20_000)]
    return rows


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, DDL)
    if extra:
        df = df.selectExpr("*", "turn AS depth", "text AS a", "conv_id AS part", "role AS words")
    return df


@pytest.mark.parametrize("limit,shards", [(100_000, None), (3, 23), (2, 1)])
def test_every_node(spark, limit, shards):
    rows = awkward()
    random.Random(1).shuffle(rows)
    got = prefix_trie.report(frame(spark, rows, extra=True), 20, limit, shards)
    assert collected(got, *COLUMNS) == brute(rows)


def test_sql(spark):
    rows = awkward()
    table = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
    table = table.astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", table)
    found = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({prefix_trie.ORACLE})").fetchall()
    assert sorted(found, key=repr) == brute(rows)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in read(spark, sf_dir, "conversations").collect()]
    got = QUERIES["op11_prefix_trie"](spark, sf_dir)
    assert collected(got, *COLUMNS) == brute(rows)


def test_a_conversation_over_many_parts(spark):
    rows = [(20, t, "user", f"turn {t}") for t in range(400)]
    rows += [(40, t, "user", f"turn {t}") for t in range(300)] + [(41, 0, "user", "own")]
    df = frame(spark, rows)
    assert prefix_trie.turns(df).where("conv_id = 20").select("part").distinct().count() > 1
    assert collected(prefix_trie.report(df), *COLUMNS) == brute(rows)


def test_empty(spark):
    none = frame(spark, [])
    assert prefix_trie.report(none).collect() == []
    nobody = frame(spark, [(None, 0, "user", "text")])
    assert prefix_trie.report(nobody).collect() == []


def test_queue_spills_and_keeps_the_order():
    rng = random.Random(4)
    queue, expected = prefix_trie.MessageQueue(limit=5), []
    for _ in range(300):
        message = (rng.randrange(9), rng.randrange(9), 1, 2, 3)
        queue.push(message)
        expected.append(message[:2])
    assert queue.n_runs > 10
    while expected:
        slot = min(expected)
        n = expected.count(slot)
        assert queue.peek()[:2] == slot
        assert queue.take(slot) == [n, 2 * n, 3 * n]
        expected = [e for e in expected if e != slot]
    assert queue.peek() is None


def test_chunks_carry_a_digest(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS_BYTES", 50)
    rows = [(i, 0, "user", "") for i in range(0, 4000, 20)]
    got = prefix_trie.report(frame(spark, rows))
    assert collected(got, *COLUMNS) == brute(rows)
