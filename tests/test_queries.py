"""Every registered query agrees with its DuckDB statement on the smallest tables."""

import duckdb
import pytest

from shelfspark.plans import registry
from shelfspark.plans.derived import BASE_TABLES

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame):
    frame = frame[sorted(frame.columns)]
    def cell(v):
        if v is None or v != v:
            return "null"
        return str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)
    return sorted(tuple(cell(v) for v in row) for row in frame.astype(object).itertuples(index=False, name=None))


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    duck.execute(ORACLES[name])
    expected = duck.fetchdf().astype(object)
    assert sorted(got.columns) == sorted(expected.columns)
    expected = expected.where(expected.notna(), None)
    assert canonical(got) == canonical(expected)
