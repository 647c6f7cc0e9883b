"""All registered queries: importing the query modules fills the registry."""

from __future__ import annotations

from rill.plans import (q_graph, q_recommend, q_relational, q_similarity,  # noqa: F401
                        q_sorting, q_sources, q_streaming)
from rill.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
