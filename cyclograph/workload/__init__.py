"""Registered queries: each a DataFrame function with, where SQL can say it, its SQL twin."""

from cyclograph.workload import analytics, calendars, landing, model, quality_checks, streams  # noqa: F401
from cyclograph.workload.registry import QUERIES, SQL  # noqa: F401
