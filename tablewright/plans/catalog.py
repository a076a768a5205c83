"""All registered queries."""

from tablewright.plans import records, results, telemetry, text_metrics  # noqa: F401
from tablewright.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
