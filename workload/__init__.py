"""Registered queries over the benchmark tables and the SQL that checks them."""

from __future__ import annotations

from importlib import import_module

MODULES = ("kpi_queries", "anomaly_queries", "causal_queries", "decision_queries", "quality_queries", "profile_queries", "stream_queries")


def load_all():
    """(queries, oracles) of all modules."""
    from workload import registry

    for name in MODULES:
        import_module(f"workload.{name}")
    return registry.QUERIES, registry.ORACLES
