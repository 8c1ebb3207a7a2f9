"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from tessera.llm import bpe, fingerprints, licenses, mixing, near_duplicates, pii, quality_model, quality_rules, url_filter, warc

MODULES = (near_duplicates, url_filter, fingerprints, licenses, warc, pii, bpe, mixing, quality_rules, quality_model)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
