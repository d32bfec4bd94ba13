"""All queries of the core, with the SQL that checks them."""

from __future__ import annotations

from lexweave.plans import analytics_queries, core_queries, explore_queries, graph_queries, relational_queries, text_queries

_MODULES = [analytics_queries, core_queries, graph_queries, explore_queries, relational_queries, text_queries]


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.ORACLE.items()}


def flagship(spark, sf_dir: str):
    return queries()["g13_full_reduction"](spark, sf_dir)
