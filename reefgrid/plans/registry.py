"""All registered queries."""

from __future__ import annotations

from reefgrid.plans import catalog_queries, model_queries, report_queries, splat_queries, stream_queries, text_queries, vocab_queries

MODULES = [
    model_queries, splat_queries, catalog_queries, report_queries, stream_queries, text_queries, vocab_queries,
]


def queries() -> dict:
    return {name: fn for module in MODULES for name, fn in module.query.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.query.ORACLES.items()}
