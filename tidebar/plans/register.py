"""Registration of queries: a function of the relations, and the SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidebar.plans.dates import DATE_COLUMNS
from tidebar.sources.adapters import CTES, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def with_ctes(sql: str, more: dict[str, str] | None = None) -> str:
    """The SQL with the common table expressions that it names, directly or through others, before it."""
    ctes = {**CTES, **(more or {})}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in ctes:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(ctes[name])

    visit(sql)
    chosen = ", ".join(f"{name} AS MATERIALIZED ({ctes[name]})" for name in ctes if name in needed)
    if not chosen:
        return sql
    return f"WITH {chosen}, {sql[5:]}" if sql.startswith("WITH ") else f"WITH {chosen} {sql}"


def _timed(df: DataFrame, dates: tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: df[c].cast("timestamp") for c in dates}) if dates else df


def query(key: str, sql: str | None = None, more: dict[str, str] | None = None):
    """Register a function (Tables) -> DataFrame under a key."""

    def keep(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        dates = DATE_COLUMNS.get(key, ())
        QUERIES[key] = lambda spark, folder: _timed(f(Tables(spark, folder)), dates)
        if sql:
            text = with_ctes(" ".join(sql.split()), more)
            replaced = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in dates)
            SQL[key] = f"SELECT * REPLACE ({replaced}) FROM ({text})" if dates else text
        return f

    return keep
