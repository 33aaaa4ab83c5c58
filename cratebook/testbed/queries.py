"""All registered queries."""

from cratebook.testbed import (  # noqa: F401
    queries_library,
    queries_overlap,
    queries_plans,
    queries_plays,
    queries_sets,
    queries_sources,
)
from cratebook.testbed.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
