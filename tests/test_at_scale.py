"""The same results when nothing may be broadcast and one key holds a third of the rows."""

import duckdb
import pytest

import __spark_entry__ as spark_entry
from tests.test_oracle import normal

# Small enough that AQE sees every hot partition as skewed and splits it.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
}

QUERIES = [
    "trips_by_borough", "daily_trends_joined", "pickup_vs_dropoff", "top_zones",
    "hist_distance", "filtered_dashboard", "load_outcome", "conversation_chats",
    "conversation_chats_federated", "tpch_wide",
]


@pytest.fixture(scope="module")
def skewed(sf_dir, tmp_path_factory):
    """A copy of the tables where one supplier, part, order, customer and conversation
    holds a third of all rows."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    changes = {
        "lineitem": "* REPLACE (CASE WHEN rowid_ % 3 = 0 THEN 7 ELSE l_suppkey END AS l_suppkey, "
                    "CASE WHEN rowid_ % 3 = 1 THEN 11 ELSE l_partkey END AS l_partkey, "
                    "CASE WHEN rowid_ % 3 = 2 THEN 13 ELSE l_orderkey END AS l_orderkey)",
        "orders": "* REPLACE (CASE WHEN rowid_ % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey)",
        "conversations": "* REPLACE (CASE WHEN rowid_ % 3 = 0 THEN 0 ELSE conv_id END AS conv_id, "
                         "CASE WHEN rowid_ % 3 = 0 THEN 1000 + rowid_ ELSE turn END AS turn)",
    }
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "conversations"):
        numbered = f"(SELECT *, row_number() OVER () AS rowid_ FROM '{sf_dir}/{name}.parquet')"
        columns = changes.get(name, "*").replace("*", "* EXCLUDE (rowid_)", 1)
        # Several files, because a task can only be split between the files it reads from.
        target = folder / f"{name}.parquet"
        target.mkdir()
        for part in range(4):
            con.execute(
                f"COPY (SELECT {columns} FROM {numbered} WHERE rowid_ // 3 % 4 = {part}) "
                f"TO '{target}/part-{part}.parquet' (FORMAT parquet)"
            )
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{target}/*.parquet'")
    return str(folder), con


@pytest.fixture(scope="module")
def large(spark):
    before = {k: spark.conf.get(k, None) for k in LARGE}
    for key, value in LARGE.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_tables_without_broadcast(large, skewed, name):
    folder, con = skewed
    df = spark_entry.queries()[name](large, folder)
    result = con.execute(spark_entry.oracle_sql()[name])
    want = normal([d[0] for d in result.description], result.fetchall())
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == want


def test_hot_keys_are_split(large, skewed):
    df = spark_entry.queries()["tpch_wide"](large, skewed[0])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan.split("== Initial Plan ==")[0]
