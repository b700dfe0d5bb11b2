"""Named queries over the benchmark tables, each with an equivalent in plain SQL."""

from isobar.plans import anomaly, climate, live, streams  # noqa: F401  (registers the queries)
from isobar.plans.registry import Query, registered

__all__ = ["Query", "registered"]
