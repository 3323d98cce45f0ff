"""Every query against its SQL, on the small tables and on a skewed copy without broadcasts."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from driver_queries import QUERIES
from starmill.operators import joins, upserts
from tools.check_oracle import rows_of

SMALL = "/root/testdata/sf0.001"

# lookup joins, merges and counts, whose plan depends on the size of a table
SKEW_SENSITIVE = [
    "star_songplays", "star_join_all", "fact_left_first_match", "fact_inner_title", "fact_three_key",
    "left_chain_coalesce", "song_lookup", "report_drug_lines", "reaction_trend", "drug_profile",
    "upsert_do_nothing", "upsert_latest", "plays_by_weekday", "dq_foreign_key", "drug_event_ids",
    "upsert_latest_touched", "incremental_load_bitmap", "price_history", "report_join_stored", "leading_reactions",
]


def connect(folder):
    con = duckdb.connect()
    for name in ("customer", "supplier", "part", "orders", "lineitem", "events", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def small():
    return connect(SMALL)


def assert_same(spark, con, folder, name):
    df = queries()[name](spark, folder)
    got, columns = rows_of(df.columns, df.collect())
    cursor = con.execute(oracle_sql()[name])
    want, want_columns = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    assert columns == want_columns
    assert got == want


def test_every_query_has_sql():
    """The optional text queries, which SQL can't express, have tests of their own."""
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    assert_same(spark, small, SMALL, name)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of lines, orders and events share one key."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    changes = {
        "lineitem": "CASE WHEN l_linenumber <= 2 THEN 77 ELSE l_orderkey END AS l_orderkey, "
        "CASE WHEN hash(l_shipdate, l_orderkey) % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey, "
        "CASE WHEN hash(l_shipdate, l_partkey) % 3 = 0 THEN 5 ELSE l_suppkey END AS l_suppkey",
        "orders": "CASE WHEN hash(o_orderkey) % 3 = 0 THEN 9 ELSE o_custkey END AS o_custkey",
        "events": "CASE WHEN hash(event_id) % 3 = 0 THEN 11 ELSE user_id END AS user_id",
    }
    for name in ("customer", "supplier", "part", "orders", "lineitem", "events", "conversations"):
        columns = f"* REPLACE ({changes[name]})" if name in changes else "*"
        con.execute(f"COPY (SELECT {columns} FROM '{SMALL}/{name}.parquet') TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", SKEW_SENSITIVE)
def test_query_on_skewed_tables_without_broadcast(spark, skewed, name, monkeypatch):
    for module in (joins, upserts):
        monkeypatch.setattr(module, "fits_broadcast", lambda *_, **__: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert_same(spark, connect(skewed), skewed, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "songplay_id" in df.columns
