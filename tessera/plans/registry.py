"""All queries of the engine by name, and their SQL for the oracle."""

from __future__ import annotations

from tessera.operators import agreement, benchmarks, builders, chemistry, consensus, curation, evidence, extraction, lookups, materials, models, normalization, quality, relational, retrieval, review, splits
from tessera.streaming import feeds

MODULES = (consensus, relational, builders, lookups, evidence, normalization, chemistry, materials, extraction, curation, agreement, quality, review, splits, benchmarks, retrieval, models, feeds)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
