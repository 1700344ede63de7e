"""All queries and oracle SQL of the subpackage."""

from __future__ import annotations

from . import exact_dedup, hmm, langid, licenses, mixing, packing, quality, simhash, toxicity, warc

MODULES = [exact_dedup, quality, licenses, packing, warc, mixing, toxicity, langid, simhash, hmm]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in m.ORACLE.items()}
