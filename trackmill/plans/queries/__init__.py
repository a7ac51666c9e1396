"""Named queries over the given tables, each with equal SQL where SQL can say it."""

from trackmill.plans.queries import files, jobs, models, rows, streams, tracks  # noqa: F401
from trackmill.plans.queries.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
