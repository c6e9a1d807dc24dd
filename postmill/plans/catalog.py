"""All registered queries of the postings engine; importing a module registers its queries."""

from postmill.functions import names  # noqa: F401
from postmill.operators import chain, changes, checks, dedup, enrich, gates, learned, monitor, places, sinks  # noqa: F401
from postmill.plans import flows, marts, reports  # noqa: F401
from postmill.plans.registry import ORACLES, QUERIES
from postmill.sources import feeds, pages  # noqa: F401
from postmill.streaming import streams  # noqa: F401
from postmill.plans import twins  # noqa: F401, I001  # after all queries

__all__ = ["ORACLES", "QUERIES"]
