"""Every registered query equals its SQL statement run by DuckDB (sf0.01)."""

import pytest

import __spark_entry__ as entry
from ledgerlens import plans
from compare import diff, duck, duck_fingerprint, spark_fingerprint
from conftest import SF0001, SF001

QUERIES = plans.QUERIES
SQL = plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF001)
    got, want = spark_fingerprint(df), duck_fingerprint(con, SQL[name])
    assert got == want, diff(df, con, SQL[name])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["town", "avg_price"]
    assert 0 < df.count() <= 10


def test_results_do_not_depend_on_partitioning(spark):
    """Rounded averages are identical with 1 and 8 shuffle partitions."""
    name = "stream_enriched"
    base = sorted(QUERIES[name](spark, SF0001).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert sorted(QUERIES[name](spark, SF0001).collect()) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
