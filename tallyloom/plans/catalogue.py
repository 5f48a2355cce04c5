"""All queries of the engine's own operators, with their SQL."""

from __future__ import annotations

from tallyloom.plans import agreement_queries, audit_queries, corpus_queries, file_queries, label_queries, ledger_queries  # noqa: F401  (registers its queries)
from tallyloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
