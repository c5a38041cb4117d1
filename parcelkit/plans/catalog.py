"""Imports every query module so that the registry is complete."""

from __future__ import annotations

import importlib

from parcelkit.plans.registry import BENCH, ORACLE, QUERIES  # noqa: F401

_MODULES = [
    "parcelkit.plans.q_feedback",
    "parcelkit.plans.q_clean",
    "parcelkit.plans.q_features",
    "parcelkit.plans.q_encode",
    "parcelkit.plans.q_profile",
    "parcelkit.plans.q_joins",
    "parcelkit.plans.q_metrics",
    "parcelkit.plans.q_ml",
    "parcelkit.plans.q_sources",
]

for _m in _MODULES:
    importlib.import_module(_m)
