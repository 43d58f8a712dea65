"""All registered queries."""

from __future__ import annotations

from weirgate.plans import (
    drift_plans,
    file_plans,
    gate_plans,
    model_plans,
    prep_plans,
    profile_plans,
    scoring_plans,
    selection_plans,
    streaming_plans,
)
from weirgate.plans.common import Query

MODULES = [
    profile_plans,
    prep_plans,
    drift_plans,
    file_plans,
    selection_plans,
    gate_plans,
    scoring_plans,
    model_plans,
    streaming_plans,
]


def all_queries() -> dict[str, Query]:
    return {name: fn for module in MODULES for name, fn in module.plans.queries.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.plans.oracles.items()}
