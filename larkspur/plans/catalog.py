"""All registered queries."""

from __future__ import annotations

from larkspur.plans import (  # noqa: F401
    learning_queries,
    retrieval_queries,
    source_queries,
    stream_queries,
    tabular_queries,
)
from larkspur.plans.registry import BUILDERS, ORACLES, Build


def builders() -> dict[str, Build]:
    return dict(BUILDERS)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
