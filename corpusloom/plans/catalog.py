"""Every registered query and its SQL twin."""

from __future__ import annotations

from corpusloom.plans import episode_queries, evidence_queries, ledger_queries, source_queries, table_queries
from corpusloom.plans.registry import ORACLES, QUERIES

FLAGSHIP = "ep_view_counts"
__all__ = ["FLAGSHIP", "ORACLES", "QUERIES", "episode_queries", "evidence_queries", "ledger_queries", "source_queries", "table_queries"]
