"""Layer 2: every registered query equals its DuckDB twin at sf0.01."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from locations import SF001
from scholarmetrics.plans.catalog import QUERIES
from scholarmetrics.plans.compare import compare_one, duck_connection
from scholarmetrics.plans.oracle import ORACLE_SQL

# the reference's own operators; the llm queries have tests of their own
SQL = ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF001)


def test_every_query_has_an_oracle():
    # the curve of errors on the way has no SQL twin; its last row has (mse_by_budget_last)
    assert set(QUERIES) - set(SQL) == {"mse_by_budget"} and set(SQL) < set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    r = compare_one(spark, con, name, QUERIES[name], SQL[name], SF001)
    assert r["ok"], r["problems"]
    assert r["rows"] > 0


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["paper_id", "year", "venue_key", "nb_citations"]
    assert df.count() > 0


# Queries whose lookups split hot keys (venues, the blank affiliation, fields)
# when the session's skew settings make every detection run.
SPLIT_SUBSET = [
    "affiliation_weights",
    "all_weights",
    "citations_to_year",
    "edges_with_years",
    "merged_features",
    "merged_features_by_parts",
    "paper_affiliation_feature",
    "paper_field_sum",
    "paper_venue_feature",
    "paper_venue_sum",
    "venue_weights_mean",
]


@pytest.mark.parametrize("name", SPLIT_SUBSET)
def test_query_matches_duckdb_with_hot_key_split(spark, con, split_conf, name):
    r = compare_one(spark, con, name, QUERIES[name], SQL[name], SF001)
    assert r["ok"], r["problems"]


@pytest.fixture
def large_cluster_conf(spark, split_conf):
    """Emulates the plans of a large input: every hot-key detection runs (via
    ``split_conf``) and no side is small enough to broadcast, so every join
    takes its shuffle path."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old) if old else spark.conf.unset(
        "spark.sql.autoBroadcastJoinThreshold"
    )


@pytest.mark.parametrize("name", sorted(set(SQL) - set(SPLIT_SUBSET)))
def test_query_matches_duckdb_on_shuffle_paths(spark, con, large_cluster_conf, name):
    r = compare_one(spark, con, name, QUERIES[name], SQL[name], SF001)
    assert r["ok"], r["problems"]


def test_hot_keys_are_salted_on_fixture(spark, split_conf):
    from scholarmetrics.plans.inspect import plan_text

    assert "__salt" in plan_text(QUERIES["paper_venue_sum"](spark, SF001))
