"""Joins without moving rows, counts from footers, listings compared by ranges."""

from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.operators import files
from tripspark.plans import catalogue, gold, silver
from tripspark.sources import tables


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_bucketed_trips_are_not_moved(spark, sf_dir, tmp_path):
    star = catalogue.star_of(spark, sf_dir, years_cut=1)
    names = "trips_by_minute", "minutes_by_minute"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    silver.write_by_minute(star, *names, buckets=6, hot=1, folder=str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        daily = gold.daily_trends_bucketed(spark, *names)
        text = executed(daily)
        want = gold.daily_trends_joined(star).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert daily.collect() == want and any(r.trip_date is None for r in want)
    join = text[text.index("SortMergeJoin") :]
    assert "Exchange" not in join and join.count("Bucketed: true") == 2
    assert "SelectedBucketsCount: 6 out of 6" in join
    slots = spark.table(names[0]).groupBy("minute").agg(
        F.countDistinct("slot").alias("slots"), F.count("*").alias("n")
    )
    assert slots.filter("n = 1").agg(F.max("slots")).first()[0] == 1
    assert slots.agg(F.max("slots")).first()[0] > 1


def test_only_busy_minutes_are_divided(spark, sf_dir, tmp_path):
    star = catalogue.star_of(spark, sf_dir)
    one = 199601011200
    third = F.when(col("TripID") % 3 == 0, one).otherwise(col("PickupDateTimeID"))
    fact = star.fact.withColumn("PickupDateTimeID", third)
    fact.write.parquet(str(tmp_path / "fact"))
    star = star.with_fact(spark.read.parquet(str(tmp_path / "fact")))
    names = "trips_busy_minute", "minutes_busy_minute"
    silver.write_by_minute(star, *names, buckets=3, slots=4, hot=100, folder=str(tmp_path))
    divided = spark.table(names[1]).groupBy("minute").count().filter("count > 1").collect()
    assert [tuple(r) for r in divided] == [(one, 4)]
    daily = gold.daily_trends_bucketed(spark, *names)
    assert daily.collect() == gold.daily_trends(star).collect()


def test_inventory_reads_footers_only(spark, sf_dir, tmp_path):
    df = catalogue.table_footers(spark, sf_dir)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("RelationV2") == len(catalogue.KEYS)
    assert physical.count("PushedAggregation: [COUNT(*), MIN(") == len(catalogue.KEYS)
    spark.range(5).write.parquet(str(tmp_path / "a"))
    spark.range(0).write.parquet(str(tmp_path / "none"))
    found = tables.inventory(
        spark,
        {
            "a": (str(tmp_path / "a"), "id"),
            "plain": (str(tmp_path / "a"), None),
            "none": (str(tmp_path / "none"), "id"),
        },
    )
    assert sorted(map(tuple, found.collect())) == [
        ("a", 5, 0, 4), ("none", 0, None, None), ("plain", 5, None, None),
    ]
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_only_ranges_that_differ_are_joined(spark):
    names = spark.range(20_000).select(
        F.concat(F.lit("day/"), "id").alias("rel_path"), (col("id") % 999).alias("length")
    )
    changed = F.when(col("rel_path") == "day/7", col("length") + 1).otherwise(col("length"))
    there = names.filter(~col("rel_path").isin("day/5", "day/19999"))
    target = there.withColumn("length", changed).union(
        spark.createDataFrame([("extra", 1)], names.schema)
    )
    assert 0 < files.differing_ranges(names, target).count() <= 4
    here, other, same = files._in_differing(names, target, files.RANGES)
    assert here.count() + other.count() < 60 and same.count() > 19_900
    for few in (1, 7, files.RANGES):
        got = files.validate_by_ranges(names, target, few)
        want = files.validate(names, target)
        rows = got.select(want.columns).collect()
        assert sorted(map(repr, rows)) == sorted(map(repr, want.collect()))
        new = files.new_files_by_ranges(names, target, few)
        assert sorted(r.rel_path for r in new.collect()) == ["day/19999", "day/5"]
    assert files.differing_ranges(names, names.repartition(9)).isEmpty()
    nothing = names.filter("false")
    assert files.validate_by_ranges(nothing, names).isEmpty()
    assert files.new_files_by_ranges(names, nothing).count() == 20_000
