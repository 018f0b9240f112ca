"""Small tables with the awkward cases: NULLs, empty texts, repeats, ties, extra columns."""

import random

DOCS_DDL = "doc_id long, text string, lang string, source string, n_chars long"

# Names that operators use for their own columns.
EXTRA = (
    "row_hash long, fp long, root long, bitmap string, positions string, contaminated string, "
    "kept string, chosen_id string, bad_id string, n_lines string, marks string, docs string"
)


def prose(rng: random.Random, words: int, vocabulary: int = 5000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(words)]


def docs(spark, rows, extra=False):
    """Documents from (doc_id, text) pairs, on request with clashing extra columns."""
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, DOCS_DDL)
    if extra:
        for field in EXTRA.split(", "):
            name, kind = field.split()
            df = df.selectExpr("*", f"CAST(doc_id AS {kind}) AS {name}")
    return df


def edge_rows():
    """Rows that every operator on documents must take."""
    rng = random.Random(5)
    line = "the same long line that is repeated in very many of the documents here"
    long_text = " ".join(prose(rng, 30_000))
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, "Ünïcode wörds ß 漢字 \x1c here there"),
        (6, long_text),
        (7, "tie " * 40),
        (7, "tie " * 40),
        (8, "first text of a repeated id " + " ".join(prose(rng, 60))),
        (8, "second text of it " + " ".join(prose(rng, 60))),
        (None, "no id " + " ".join(prose(rng, 80))),
        (None, None),
        (None, line),
    ]
    for i in range(20, 40):
        own = " ".join(prose(rng, 60))
        rows.append((i, f"{own}\n  {line.upper()}\t\n{own}"))
    return rows


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
