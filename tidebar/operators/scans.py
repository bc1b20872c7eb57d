"""Running values over very long series, in two levels.

A series is cut into slices of time. Within each a window gives the running value from the slice's start; one row a slice says
what the whole slice amounts to, a window over these few rows what all slices before a slice do, and that is put before
the values within. A series is then as many tasks as it has slices, however many of all rows it holds. Rows move once,
by series and slice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """How values run: over a window, and what two stretches one after the other amount to."""

    over: Callable[[Column], Column]
    join: Callable[[Column, Column], Column]


def _either(value: Column, before: Column, after: Column) -> Column:
    return F.coalesce(value, before, after)


#: Of a stretch: nulls count for nothing, and a stretch of nulls alone is null.
KINDS = {
    "sum": Kind(F.sum, lambda before, after: _either(before + after, before, after)),
    "product": Kind(F.product, lambda before, after: _either(before * after, before, after)),
    "max": Kind(F.max, F.greatest),
    "min": Kind(F.min, F.least),
    "last": Kind(lambda c: F.last(c, ignorenulls=True), lambda before, after: F.coalesce(after, before)),
}


def month(column: str) -> Column:
    """The slice of a date or time: its month, as a number."""
    return F.year(column) * 12 + F.month(column)


def running(df: DataFrame, values: dict[str, tuple[str, Column]], by: Sequence[str] = ("symbol",), order: Sequence[Column | str] = ("timestamp",), part: Column | None = None, falling: bool = False) -> DataFrame:
    """df with running values up to each row: name -> (kind of KINDS, value).

    order: within a series, from first to last, of which part (by default the month of the first) is a rising function; falling: from last to
    first. Null parts come first. Rows of one place in the order run in some order, as in any window. Null keys are a series of their own.
    """
    part = month(order[0]) if part is None else part
    names = {name: f"_{name}_" for name in values}
    turned = [(F.col(c) if isinstance(c, str) else c) for c in order]
    turned = [c.desc() if falling else c.asc() for c in turned]
    rows = df.withColumns({"_part": part} | {names[n]: value for n, (_, value) in values.items()})
    within = Window.partitionBy(*by, "_part").orderBy(*turned)
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({names[n]: KINDS[kind].over(F.col(names[n])).over(upto) for n, (kind, _) in values.items()} | {"_place": F.row_number().over(within)})
    # a slice's last running values are what it amounts to: rows of a slice are together already
    whole = local.groupBy(*by, "_part").agg(*(F.max_by(c, "_place").alias(c) for c in names.values()))
    parts = Window.partitionBy(*by).orderBy(F.col("_part").desc() if falling else F.col("_part").asc()).rowsBetween(Window.unboundedPreceding, -1)
    before = whole.select(*(F.col(c).alias(f"_by{k}") for k, c in enumerate(by)), F.col("_part").alias("_of"), *(KINDS[kind].over(F.col(names[n])).over(parts).alias(f"{names[n]}b") for n, (kind, _) in values.items()))
    match = F.col("_part").eqNullSafe(F.col("_of"))
    for k, c in enumerate(by):
        match = match & F.col(c).eqNullSafe(F.col(f"_by{k}"))
    joined = local.join(before, match, "left")
    return joined.select(*(F.col(c) for c in df.columns if c not in values), *(KINDS[kind].join(F.col(f"{names[n]}b"), F.col(names[n])).alias(n) for n, (kind, _) in values.items()))
