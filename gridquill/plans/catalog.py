"""All queries of the table question answering part, with their SQL."""

from __future__ import annotations

from functools import wraps

from ..session import workers_see_package
from . import queries_files, queries_rank, queries_rules, queries_tables


def _with_package(query):
    @wraps(query)
    def run(spark, sf_dir):
        return query(workers_see_package(spark), sf_dir)

    return run


QUERIES: dict = {}
ORACLE_SQL: dict = {}
for module in (queries_tables, queries_rank, queries_rules, queries_files):
    QUERIES |= {name: _with_package(query) for name, query in module.QUERIES.items()}
    ORACLE_SQL |= module.ORACLE_SQL
ORACLE_SQL["stored_search"] = ORACLE_SQL["bm25_topk"]
