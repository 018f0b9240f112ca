import random

import pytest

import corpus_pipeline
from tests.llm import test_decontaminate, test_line_dedup, test_quality, test_simhash
from tests.llm.data import collected, docs, edge_rows, prose
from tripspark.llm import quality_rules


def tables(spark, folder):
    """Documents of every kind that a stage acts on, with an extra column."""
    rng = random.Random(21)
    rows, marks = test_quality.labelled_docs(120)
    rows += test_simhash.near_copies(rng, 12)
    items = [(i, " ".join(prose(rng, 30))) for i in range(5)]
    rows += [(3000 + i, f"{items[i % 5][1]} " + " ".join(prose(rng, 20 * i))) for i in range(10)]
    line = " ".join(prose(rng, 15))
    rows += [(4000 + i, " ".join(prose(rng, 60)) + "\n" + line) for i in range(9)]
    rows += edge_rows()
    docs(spark, rows, extra=True).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    test_quality.labels(spark, marks).write.parquet(f"{folder}/labels.parquet")
    return items


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    return str(path), tables(spark, str(path))


def test_each_stage(spark, folder):
    path, items = folder
    current = spark.read.parquet(f"{path}/documents.parquet")
    schema = current.schema
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = pairs(current)
        current = stage(spark, current, path)
        current.write.parquet(f"{path}/{name}")
        current = spark.read.parquet(f"{path}/{name}")
        assert current.schema == schema
        after = sorted(pairs(current), key=repr)
        if number == 0:
            labels = spark.read.parquet(f"{path}/labels.parquet")
            report = quality_rules.report(spark.createDataFrame(before, "doc_id long, text string"), labels)
            want = [r["doc_id"] for r in report.collect() if r["kept"]]
            assert sorted((d for d, _ in after), key=repr) == sorted(want, key=repr)
            assert 40 not in want and 41 in want  # junk goes, prose stays
        elif number == 1:
            want = [
                (d, t if not n else kept)
                for (d, t), (_, _, n, kept) in zip(before, test_line_dedup.brute(before), strict=True)
            ]
            assert after == sorted(want, key=repr) and before != after
        elif number == 2:
            groups = test_simhash.brute(before)
            assert {d for d, _ in after} == {c for _, _, c in groups}
            assert 0 < len(after) < len(before)
            assert len(set(after)) == len(after)
        else:
            judged = test_decontaminate.brute(before, items)
            want = [b for b, (*_, bad) in zip(before, judged, strict=True) if not bad]
            assert after == sorted(want, key=repr) and len(after) < len(before)
    last = corpus_pipeline.STAGES[-1][1](spark, current, path)
    run = corpus_pipeline.run(spark, path)
    columns = ("doc_id", "start", "length", "doc_tokens")
    total = [{r["doc_id"] for r in df.collect()} for df in (last, run)]
    assert total[0] == total[1] == {r["doc_id"] for r in current.collect()}
    assert sum(r[2] for r in collected(run, *columns)) == sum(r[2] for r in collected(last, *columns))


def test_empty_tables(spark, tmp_path):
    for name, ddl in (
        ("documents", "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", "doc_id long, quality int, toxic int"),
        ("benchmark", "item_id long, text string"),
    ):
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "simhash_near_dedup", "decontamination", "packing"
    ]
