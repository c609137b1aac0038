"""Operators for preparing training data, and their queries.

Nothing else in the library imports this package.
"""

from __future__ import annotations


def load_queries() -> dict:
    """The registered queries of this package by name."""
    from txlake.llm import queries

    return dict(queries.REGISTRY)
