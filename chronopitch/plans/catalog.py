"""All queries of the core by name."""

from __future__ import annotations

from chronopitch.plans import data_queries, live_queries, model_queries, ops_queries, pit_queries, population_queries, read_queries, recon_queries, scalar_queries, source_queries

PLANS = (data_queries, live_queries, model_queries, ops_queries, pit_queries, population_queries, read_queries, recon_queries, scalar_queries, source_queries)
QUERIES = {name: f for plan in PLANS for name, f in plan.QUERIES.items()}
ORACLE = {name: sql for plan in PLANS for name, sql in plan.ORACLE.items()}
