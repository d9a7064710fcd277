"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

import importlib

_MODULES = ("gazette.plans.dedup_plans", "gazette.plans.page_plans", "gazette.plans.feed_plans", "gazette.plans.digest_plans", "gazette.plans.edition_plans", "gazette.plans.text_plans", "gazette.plans.stream_plans", "gazette.plans.run_plans", "gazette.plans.hook_plans")


def _collect(attr):
    out = {}
    for m in _MODULES:
        out.update(getattr(importlib.import_module(m), attr))
    return out


def queries():
    return _collect("QUERIES")


def oracles():
    return _collect("ORACLES")
