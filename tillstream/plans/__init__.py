"""Named analytical queries and their checking SQL."""

from __future__ import annotations


def load() -> tuple[dict, dict]:
    """All queries and checks, with every query module imported."""
    from tillstream.plans import billing, profiles, registry, risk, settlement, streams  # noqa: F401

    return dict(registry.QUERIES), dict(registry.CHECKS)
