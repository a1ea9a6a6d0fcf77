"""Queries over the driver tables: each pairs a Spark plan with an independent SQL text."""

from __future__ import annotations

import importlib

MODULES = [
    "interval_plans", "sequence_plans", "link_plans", "measure_plans", "scalar_plans", "rule_plans", "version_plans", "flow_plans", "stream_plans",
]


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"cuelake.plans.{name}")


def all_plans():
    from cuelake.plans.registry import PLANS, runner

    _load()
    return {name: runner(build) for name, build in PLANS.items()}


def all_checks():
    from cuelake.plans.registry import CHECKS

    _load()
    return dict(CHECKS)
