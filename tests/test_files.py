"""Reconciling folders, against plain file system calls."""

import hashlib

import pytest

from tripspark.operators import files


@pytest.fixture
def folders(tmp_path):
    source, target = tmp_path / "source", tmp_path / "target"
    for root, names in (
        (source, {"year=2024/month=1/day=1/a.parquet": b"aaaa", "year=2024/b.parquet": b"bb",
                  "c.parquet": b"c", "notes.txt": b"skip"}),
        (target, {"year=2024/month=1/day=1/a.parquet": b"aaaa", "c.parquet": b"ccc",
                  "old.parquet": b"x"}),
    ):
        for name, content in names.items():
            path = root / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(content)
    return str(source), str(target)


def test_manifest_lists_without_reading(spark, folders):
    df = files.manifest(spark, folders[0])
    assert sorted(map(tuple, df.collect())) == [
        ("c.parquet", 1), ("year=2024/b.parquet", 2), ("year=2024/month=1/day=1/a.parquet", 4),
    ]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    keys = files.target_keys(df, "bronze/trips/").select("key").collect()
    assert ("bronze/trips/c.parquet",) in [tuple(k) for k in keys]


def test_new_files_validation_and_stats(spark, folders):
    source, target = (files.manifest(spark, f) for f in folders)
    assert [r["rel_path"] for r in files.new_files(source, target).collect()] == [
        "year=2024/b.parquet"
    ]
    checked = files.validate(source, target)
    assert {r["rel_path"]: r["status"] for r in checked.collect()} == {
        "c.parquet": "size_mismatch",
        "year=2024/b.parquet": "missing",
        "year=2024/month=1/day=1/a.parquet": "ok",
    }
    assert tuple(files.verdict(checked).first()) == (2, False)
    assert tuple(files.verdict(files.validate(source, source)).first()) == (0, True)
    assert sorted(map(tuple, files.load_stats(source, target).collect())) == [
        ("new", 1, 2), ("skipped", 2, 5),
    ]


def test_hashes(spark, folders):
    got = {r["rel_path"]: r["md5"] for r in files.content_hashes(spark, folders[0]).collect()}
    assert got["year=2024/b.parquet"] == hashlib.md5(b"bb").hexdigest()
    assert len(got) == 3


def test_empty_folder(spark, tmp_path):
    (tmp_path / "notes.txt").write_text("x")
    listing = files.manifest(spark, str(tmp_path))
    assert files.is_empty(listing)
    assert tuple(files.verdict(files.validate(listing, listing)).first()) == (0, True)
