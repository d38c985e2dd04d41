"""Every registered query against its DuckDB SQL on the same tables (sf0.001)."""

import pytest

import __spark_entry__ as entry
from brightwash.plans.queries import QUERIES as TABLE_QUERIES
from oracle_compare import duck, rows_of
from conftest import SF001

# the optional subpackage has tests of its own
QUERIES = {name: fn for name, fn in entry.queries().items() if name in TABLE_QUERIES}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_oracle():
    assert QUERIES and set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    spark_rows, spark_cols = rows_of(df.columns, [tuple(r) for r in df.collect()], None)
    res = con.execute(SQL[name])
    duck_rows, duck_cols = rows_of([d[0] for d in res.description], res.fetchall(), None)
    assert spark_cols == duck_cols
    assert sorted(spark_rows, key=repr) == sorted(duck_rows, key=repr)
