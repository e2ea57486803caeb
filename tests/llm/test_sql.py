"""Queries with SQL equal DuckDB's result at sf0.01."""

import pytest

from compare import diff, duck, duck_fingerprint, spark_fingerprint
from ledgerlens.llm.oracle import SQL
from ledgerlens.llm.queries import QUERIES
from support import DIR


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    df, con = QUERIES[name](spark, DIR), duck(DIR)
    assert spark_fingerprint(df) == duck_fingerprint(con, SQL[name]), diff(df, con, SQL[name])
