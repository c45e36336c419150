"""All registered queries and their DuckDB statements."""

from __future__ import annotations

import functools

from shelfspark.plans import (
    catalog_queries, extract_queries, operations_queries, packaging_queries, relational_queries, source_queries, supplier_queries,
)
from shelfspark.session import configure

_MODULES = [catalog_queries, extract_queries, operations_queries, packaging_queries, relational_queries, source_queries, supplier_queries]


def _configured(query):
    @functools.wraps(query)
    def run(spark, sf_dir):
        return query(configure(spark), sf_dir)
    return run


def queries() -> dict:
    return {name: _configured(fn) for module in _MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
