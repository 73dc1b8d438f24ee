"""All registered queries (importing the query modules registers them)."""

from __future__ import annotations

from . import oracle_sql as O
from . import q_core, q_datasets, q_features, q_models, q_scoring, q_store  # noqa: F401  (registration side effects)
from .registry import ORACLE, QUERIES

ORACLE.update({k: O.ieee_round(v) for k, v in ORACLE.items()})

__all__ = ["ORACLE", "QUERIES"]
