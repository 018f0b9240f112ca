import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tests.llm.data import collected, docs, edge_rows, prose
from tripspark.llm import simhash


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, distance=2):
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= distance:
            root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    least = {
        r: min((d for d in ids if d is not None), default=None) for r, ids in members.items()
    }
    return [(rows[i][0], f"{prints[i]:016x}", least[find(i)]) for i in range(len(rows))]


def near_copies(rng, groups=25, copies=6):
    rows, doc = [], 1000
    for _ in range(groups):
        words = prose(rng, 300)
        for _ in range(rng.randrange(1, copies)):
            changed = list(words)
            for _ in range(rng.randrange(3)):
                changed[rng.randrange(300)] = "changed"
            rows.append((doc, " ".join(changed)))
            doc += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [edge_rows(), near_copies(random.Random(3))])
def test_groups(spark, rows):
    got = collected(simhash.report(docs(spark, rows)), "doc_id", "fingerprint", "component_id")
    assert got == sorted(brute(rows), key=repr)


def test_hot_fingerprint(spark):
    """Copies that hold most rows beside fingerprints of a row each; repeated and missing ids."""
    rng = random.Random(6)
    hot = " ".join(prose(rng, 40))
    rows = [(i % 250 if i % 9 else None, hot) for i in range(300)]
    rows += [(1000 + i, None) for i in range(60)] + near_copies(rng, 10, 3)
    got = collected(simhash.report(docs(spark, rows)), "doc_id", "fingerprint", "component_id")
    assert got == sorted(brute(rows), key=repr)


def test_links_in_tiles(spark):
    """A bucket that is cut into many tiles gives the same components as all pairs."""
    rng = random.Random(4)
    base = rng.getrandbits(64)
    values = {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(400)}
    values |= {rng.getrandbits(64) for _ in range(100)}
    signed = [(int(np.uint64(v).view(np.int64)),) for v in values]
    df = spark.createDataFrame(signed, "fp long")
    found = simhash.components(simhash.links(df, tile=16)).collect()
    of = {r["node"]: r["root"] for r in found}
    values = [s[0] for s in signed]
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in combinations(values, 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    assert {v: of.get(v, v) for v in values} == {v: find(v) for v in values}


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 7])
def test_close_pairs(radius):
    rng = np.random.default_rng(6)
    values = rng.integers(0, 2**63, 130).astype(np.uint64)
    queries = np.concatenate([values[:40] ^ np.uint64(1 << 5), values[:20] ^ np.uint64(0xF0F)])
    q, v = simhash.close_pairs(queries, values, list(range(64)), radius)
    want = {
        (i, j)
        for i, a in enumerate(queries.tolist())
        for j, b in enumerate(values.tolist())
        if (a ^ b).bit_count() <= radius
    }
    assert set(zip(q.tolist(), v.tolist(), strict=True)) == want


def test_long_chain_is_one_component(spark):
    """Each value is close to the next one only."""
    values, v = [], 0
    for bit in range(0, 63, 2):
        values.append(v)
        v |= 3 << bit
    df = spark.createDataFrame([(x,) for x in values], "fp long")
    found = simhash.components(simhash.links(df)).collect()
    assert {r["root"] for r in found} == {0}
    assert len(found) == len(values) - 1


@pytest.mark.parametrize("extra", [False, True])
def test_one_per_group(spark, extra):
    rows = edge_rows() + near_copies(random.Random(8), 10)
    df = docs(spark, rows, extra)
    out = simhash.one_per_group(df)
    assert out.schema == df.schema
    kept = [r["doc_id"] for r in out.collect()]
    want = {c for _, _, c in brute(rows)}
    assert set(kept) == want
    # The two texts of id 8 are different groups, each with id 8 as its least id.
    assert sorted(k for k in kept if kept.count(k) > 1 and k is not None) == [8, 8]


def test_empty(spark):
    assert simhash.report(docs(spark, [])).collect() == []
    assert simhash.one_per_group(docs(spark, [])).collect() == []
