"""All registered queries: importing this module fills ``QUERIES`` / ``ORACLES``."""

from strata.plans import q_history, q_ingest, q_ops, q_quality  # noqa: F401
from strata.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
