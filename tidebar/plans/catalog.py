"""All queries of the library by key, with the SQL that gives the same rows."""

from tidebar.plans import p_bars, p_cleaning, p_continuous, p_indicators, p_joins, p_more, p_quality, p_risk, p_rows, p_tables, p_windows  # noqa: F401
from tidebar.plans.register import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
