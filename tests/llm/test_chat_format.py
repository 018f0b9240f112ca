import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tripspark.llm import chat_format

DDL = "conv_id long, turn long, role string, text string, opening string, turns string, part long"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 0) for r in rows], DDL)


def many(seed=1, n=80):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        opening = f"open {rng.randrange(n // 4)}"
        turns = [("system", "be nice")] if rng.random() < 0.3 else []
        turns += [("user", opening)]
        for _ in range(rng.randrange(5)):
            turns.append((rng.choice(["assistant", "user"]), f"t{rng.randrange(3)}"))
        rows += [(conv, i, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(500, 0, None, None), (501, None, "user", "x"), (501, 0, "assistant", None),
             (502, 0, "user", "tie"), (502, 0, "user", "tie"), (503, 0, "user", "tie"),
             (503, 0, "user", "tie"), (504, 0, "user", ""), (505, 3, "assistant", "long " * 20_000),
             (506, 0, "user", "Zeile\n'quote' <|im_end|> ü")]
    return rows


def sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = con.execute(chat_format.ORACLE)
    names = [d[0] for d in found.description]
    return names, found.fetchall()


def one_opening(n=2500):
    said = {i: f"{i * 7 % 50:02} {i * 1009 % n:05}" for i in range(n)}
    return [r for i in range(n) for r in ((i, 0, "user", "hi"), (i, 1, "assistant", said[i]))]


@pytest.mark.parametrize("rows", [many(1), many(2, 30), one_opening(), []])
def test_matches_sql(spark, rows):
    names, want = sql(rows)
    got = chat_format.report(conversations(spark, rows)).select(names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_rows_without_id_give_nothing(spark):
    rows = [(None, 0, "user", "a"), (1, 0, "user", "b")]
    assert [r["chosen_id"] for r in chat_format.report(conversations(spark, rows)).collect()] == [1]


def test_pair_by_hand(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "more"),
            (2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 2, "assistant", "other")]
    (r,) = chat_format.report(conversations(spark, rows)).collect()
    assert (r["chosen_id"], r["rejected_id"], r["prompt_turns"]) == (2, 1, 2)
    assert r["prompt"] == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    assert r["chosen"] == "<|im_start|>assistant\nother<|im_end|>\n"
    assert r["chosen_mask"] == "22-16" and r["rejected_mask"] == "32-0"


def test_masks_cover_the_completion(spark):
    for r in chat_format.report(conversations(spark, many(3))).collect():
        for side in ("chosen", "rejected"):
            if r[side] is not None:
                parts = [p.split("-") for p in r[side + "_mask"].split(",") if p]
                assert sum(int(a) + int(b) for a, b in parts) == len(r[side])


def test_large_opening_is_divided(spark):
    """Every conversation is in one row, however many share their opening."""
    df = spark.range(900).select(
        F.col("id").alias("conv_id"),
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("hi").alias("text")),
                F.struct(
                    F.lit(1).alias("turn"),
                    F.lit("assistant").alias("role"),
                    F.col("id").cast("string").alias("text"),
                ),
            )
        ).alias("t"),
    ).select("conv_id", "t.*")
    pairs = chat_format.preference_pairs(df, group=50).select("chosen_id", "rejected_id").collect()
    ids = [i for p in pairs for i in p if i is not None]
    assert sorted(ids) == list(range(900)) and len(pairs) < 500


@pytest.mark.parametrize("group", [None, 37])
def test_neighbours_are_paired_at_every_size(spark, group):
    """Of 2,501 with one opening those next to each other in text order meet, across ranges too."""
    n = 2501
    said = {i: f"{i * 7 % 50:02} {i * 1009 % n:05}" for i in range(n)}
    rows = [r for i in range(n) for r in ((i, 0, "user", "hi"), (i, 1, "assistant", said[i]))]
    pairs = chat_format.preference_pairs(conversations(spark, rows), group=group)
    got = {frozenset({r[0], r[1]} - {None}) for r in pairs.select("chosen_id", "rejected_id").collect()}
    order = sorted(range(n), key=lambda i: (said[i], i))
    assert got == {frozenset(order[i : i + 2]) for i in range(0, n, 2)}


def test_plan_has_no_python(spark, sf_dir, capsys):
    df = chat_format.report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    df.explain()
    assert "Python" not in capsys.readouterr().out
