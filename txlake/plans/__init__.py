"""Jobs made of sources and operators, and the registry of queries."""

from __future__ import annotations


def load_queries() -> dict:
    """All registered queries by name."""
    from txlake.plans import queries_batch, queries_streams, queries_tables  # noqa: F401
    from txlake.plans.registry import REGISTRY

    return dict(REGISTRY)
