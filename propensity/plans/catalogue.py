"""All registered queries."""

from __future__ import annotations

from propensity.plans import (  # noqa: F401
    cleaning,
    drifting,
    measuring,
    modelling,
    preparing,
    quality_checks,
    ranking,
    splitting,
    storing,
)
from propensity.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
