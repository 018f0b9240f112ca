import hashlib
import random
import re

import duckdb
import pytest

from tests.llm.data import collected, docs, edge_rows, prose
from tripspark.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, window=13):
    windows = set()
    for item, text in items:
        found = words(text)
        n = min(window, len(found))
        if item is not None and n:
            windows |= {(item, tuple(found[i : i + n])) for i in range(len(found) - n + 1)}
    out = []
    for doc, text in rows:
        found = words(text)
        hit, names = set(), set()
        for item, phrase in windows:
            for i in range(len(found) - len(phrase) + 1):
                if tuple(found[i : i + len(phrase)]) == phrase:
                    hit |= set(range(i, i + len(phrase)))
                    names.add(str(item))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        bad = bool(hit) and 20 * len(hit) >= len(found)
        out.append((doc, len(found), len(hit), len(names), digest, bad))
    return out


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def planted(rng):
    items = [(i, " ".join(prose(rng, rng.randrange(5, 40), 300))) for i in range(12)]
    items += [(20, "Two-words"), (21, ""), (22, None), (None, "no id at all"), (20, "again this"),
              (10, "Straße über alles")]
    rows = edge_rows()
    for doc in range(100, 160):
        text = prose(rng, rng.randrange(20, 200), 300)
        if doc % 3 == 0:
            item = rng.choice(items)[1] or ""
            at = rng.randrange(len(text))
            text[at:at] = [item.upper().replace(" ", ", ")]
        rows.append((doc, " ".join(text)))
    rows.append((200, "two\x00words two words straße über alles two WORDS."))
    return rows, items


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_report(spark):
    rows, items = planted(random.Random(2))
    got = collected(decontaminate.report(docs(spark, rows), benchmark(spark, items)), *COLUMNS)
    assert got == sorted(brute(rows, items), key=repr)


def test_benchmark_in_parts(spark, monkeypatch):
    """A benchmark beyond the bound is searched part by part with the same result."""
    monkeypatch.setattr(decontaminate, "PART_WORDS", 60)
    rows, items = planted(random.Random(3))
    got = collected(decontaminate.report(docs(spark, rows), benchmark(spark, items)), *COLUMNS)
    assert got == sorted(brute(rows, items), key=repr)


@pytest.mark.parametrize("part_words", [200_000, 20])
def test_rows_without_item_id_are_no_items(spark, monkeypatch, part_words):
    """In the SQL as in the query, with the benchmark in one part or several."""
    monkeypatch.setattr(decontaminate, "PART_WORDS", part_words)
    rng = random.Random(6)
    secret, other = (prose(rng, 30) for _ in range(2))
    items = [(None, " ".join(secret)), (4, " ".join(other)), (None, " ".join(other[:14])), (5, None)]
    rows = [
        (1, " ".join(secret)), (2, " ".join([*prose(rng, 50), *secret[3:20]])),
        (3, " ".join(other)), (4, " ".join(prose(rng, 40))), (5, None),
    ]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    want = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({decontaminate.ORACLE})").fetchall()
    got = collected(decontaminate.report(docs(spark, rows), benchmark(spark, items)), *COLUMNS)
    assert got == sorted(want, key=repr)
    assert [(r[0], r[COLUMNS.index("n_items")]) for r in sorted(got)] == [
        (1, 0), (2, 0), (3, 1), (4, 0), (5, 0),
    ]


@pytest.mark.parametrize("extra", [False, True])
def test_filter(spark, extra):
    rows, items = planted(random.Random(4))
    df = docs(spark, rows, extra)
    out = decontaminate.uncontaminated(df, benchmark(spark, items))
    assert out.schema == df.schema
    want = [
        (d, t) for (d, t), (*_, bad) in zip(rows, brute(rows, items), strict=True) if not bad
    ]
    assert collected(out, "doc_id", "text") == sorted(want, key=repr)


def test_matches(spark):
    item = [f"q{i}" for i in range(14)]
    other = [f"z{i}" for i in range(30)]
    rows = [(1, " ".join([*other[:7], *item, *other])), (2, " ".join(reversed(item))),
            (3, " ".join(item[:7] + other + item[7:])), (4, " ".join(item[:12]))]
    found = decontaminate.matches(
        docs(spark, rows), benchmark(spark, [(5, " ".join(item))]), span=14
    ).collect()
    phrases = {(r["doc_id"], r["position"]) for r in found if r["kind"] == "phrase"}
    assert phrases == {(1, 7), (1, 8)}
    assert {r["doc_id"] for r in found if r["kind"] == "proximity"} == {1, 2}
    assert {r["item_id"] for r in found} == {5}


def test_rarest_term_comes_first(spark):
    windows = decontaminate.windows_of([(1, b"common rare " + b"common " * 11)])
    rows = [(i, "common common common") for i in range(5)] + [(9, "rare")]
    index = decontaminate.build_index(docs(spark, rows), windows.terms)
    counts = decontaminate.term_counts(index, len(windows.terms))
    assert counts.tolist() == [15, 1]
    assert windows.rank(counts).order[13][0][0] == 1


def test_empty(spark):
    none = docs(spark, [])
    assert decontaminate.report(none, benchmark(spark, [(1, "a b")])).collect() == []
    rows = edge_rows()
    got = collected(decontaminate.report(docs(spark, rows), benchmark(spark, [])), *COLUMNS)
    assert got == sorted(brute(rows, []), key=repr)
