"""All registered queries: importing this module registers them."""

from __future__ import annotations

from candela.plans import control_queries, link_queries, panel_queries, relational_queries, source_queries, text_queries  # noqa: F401
from candela.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
