"""The registered queries: each operator on the test tables, with its SQL twin."""

from airseries.checks import cleaning, forecasts, joins, learning, scoring, series, sources  # noqa: F401
from airseries.checks.registry import oracle_sql, queries  # noqa: F401
