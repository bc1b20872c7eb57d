"""Joins: equi, range, as-of, anti and self joins over series.

Dimension sides (calendars, contracts, metadata) are small by nature; they are
broadcast where the plan says so, otherwise the session's threshold decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebar.functions.scalars import by_symbol, day, next_value, pct, r, recent
from tidebar.operators.pairs import pairs_by_date
from tidebar.operators.rolls import continuous_mapping
from tidebar.operators.scans import running
from tidebar.operators.windows import log_return


def asof(left: DataFrame, right: DataFrame, on: str, by: list[str], values: list[str], direction: str = "backward") -> DataFrame:
    """left with the values of the nearest right row at or before (backward) or at or after (forward) on.

    A union and a running last value by key, in slices of time (see scans.py): no range join, and no key in one task; right
    rows stand before left rows on equal time.
    """
    keys = [*by, on]
    a = left.select("*", F.lit(1).alias("_side"))
    b = right.select(*keys, F.struct(*values).alias("_value"), F.lit(0).alias("_side"))
    both = a.unionByName(b, allowMissingColumns=True)
    forward = direction != "backward"
    # of equal times the right rows come first, whichever way the order goes
    out = running(both, {"_found": ("last", F.col("_value"))}, by, [on, -F.col("_side") if forward else F.col("_side")], falling=forward).where("_side = 1")
    return out.select(*(F.col(c) for c in left.columns), *(F.col(f"_found.{v}").alias(v) for v in values))


def economic_calendar(econ: DataFrame, meta: DataFrame) -> DataFrame:
    return econ.join(meta, "indicator", "left")


def account_summary(balances: DataFrame, positions: DataFrame) -> DataFrame:
    """Balances with what the positions of the day add up to."""
    held = positions.select("account_id", day("timestamp").alias("date"), "symbol", "market_value", "unrealized_pnl")
    own = balances.select("account_id", day("timestamp").alias("date"), "timestamp", "cash")
    return own.join(held, ["account_id", "date"], "left").groupBy("account_id", "timestamp", "cash").agg(
        F.count_distinct("symbol").alias("symbols"), r(F.sum("market_value"), 4).alias("market_value"), r(F.sum("unrealized_pnl"), 4).alias("unrealized_pnl"),
        F.count_if(F.col("unrealized_pnl") > 0).alias("winners"), F.count_if(F.col("unrealized_pnl") < 0).alias("losers"),
    )


def active_positions(positions: DataFrame) -> DataFrame:
    """The newest snapshot of each account and symbol, if it holds anything; one aggregation, no self join."""
    last = positions.groupBy("account_id", "symbol").agg(F.max_by(F.struct("timestamp", "quantity", "market_value"), "timestamp").alias("last"))
    return last.select("account_id", "symbol", "last.*").where("quantity <> 0")


def duplicate_detail(bars: DataFrame) -> DataFrame:
    """All rows of a symbol, day and interval that has more than one."""
    w = Window.partitionBy("symbol", day("timestamp"), "interval_value", "interval_unit")
    return bars.withColumn("copies", F.count("*").over(w)).where("copies > 1")


def pair_correlation(bars: DataFrame, min_n: int = 20, days: int = 365) -> DataFrame:
    """Correlation of log returns of each pair of symbols with more than min_n common days."""
    moved = recent(bars.withColumn("ret", log_return()), days).where("ret IS NOT NULL").select("timestamp", "symbol", "ret")
    return pairs_by_date(moved, "ret").groupBy("symbol", "other").agg(r(F.corr("x", "y")).alias("correlation"), F.count("*").alias("n")).where(F.col("n") > min_n)


def period_compare(bars: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Rows of each symbol in two periods, in one pass."""
    inside = lambda p: F.col("timestamp").between(F.lit(p[0]).cast("timestamp"), F.lit(p[1]).cast("timestamp"))
    out = bars.groupBy("symbol").agg(F.count_if(inside(first)).alias("first_period"), F.count_if(inside(second)).alias("second_period"))
    return out.withColumn("difference", F.col("second_period") - F.col("first_period"))


def active_contract(bars: DataFrame, contracts: DataFrame) -> DataFrame:
    """For each root and date the contract that is alive and expires first.

    Contracts are met with the dates of their own life by an explode of the (short) life, so that the join is by
    equality; a range join over all contracts would compare each date with each contract.
    """
    alive = contracts.select("root", "symbol", "last_date", F.explode(F.sequence("first_date", "last_date")).alias("date"))
    wanted = bars.select("root", day("timestamp").alias("date")).distinct()
    return wanted.join(alive, ["root", "date"]).groupBy("root", "date").agg(F.min_by("symbol", F.struct("last_date", "symbol")).alias("active_contract"))


def nth_contract(dates: DataFrame, calendar: DataFrame, n: int) -> DataFrame:
    """The n-th contract of a root whose last day is on or after each date; dates: (root, date).

    By the rank of contracts (see continuous_mapping), so that no date meets all contracts.
    """
    return continuous_mapping(dates, calendar, n).where(F.col("position") == n).select("root", "date", F.col("symbol").alias("contract"))


def contract_chain(bars: DataFrame, contracts: DataFrame, date: str | DataFrame) -> DataFrame:
    """The contracts with a row on a date, in order of expiry; date: a literal, or a table of one row with a column of this name."""
    if isinstance(date, str):
        here = bars.where(day("timestamp") == F.lit(date).cast("date")).select("root", "symbol")
    else:
        here = bars.join(F.broadcast(date), day("timestamp") == F.col("date")).select("root", "symbol")
    chain = here.join(contracts.select("symbol", "last_date"), "symbol")
    return chain.withColumn("position", F.row_number().over(Window.partitionBy("root").orderBy("last_date", "symbol")))


def roll_prices(rolls: DataFrame, bars: DataFrame) -> DataFrame:
    """Rolls with the closes of both contracts on the roll date."""
    close = lambda name: bars.select(F.col("symbol").alias(f"{name}_contract"), day("timestamp").alias("roll_date"), F.col("close").alias(f"{name}_price"))
    return rolls.join(close("from"), ["from_contract", "roll_date"], "left").join(close("to"), ["to_contract", "roll_date"], "left")


def prices_at(rolls: DataFrame, bars: DataFrame, at: str = "instant") -> DataFrame:
    """Rolls with front_price and back_price: the closes of from_contract and to_contract at or last before a column of rolls; the back's first after it if it has none before.

    Each bar meets the rolls of its contract (two a position) and goes into their aggregates where it stands, so that bars are
    neither sorted nor shuffled, but for one row a roll and task.
    """
    columns = rolls.columns
    side = lambda name, n: F.struct(F.col(name).alias("symbol"), F.lit(n).alias("_side"))
    sides = rolls.select(*columns, F.explode(F.array(side("from_contract", 0), side("to_contract", 1))).alias("_s")).select(*columns, "_s.*")
    rows = bars.where("close IS NOT NULL").select("symbol", F.col("timestamp").cast("timestamp").alias("_time"), F.col("close").alias("_close"))
    of = lambda n: F.col("_side") == n
    before, when = F.col("_time") <= F.col(at).cast("timestamp"), lambda c, value: F.when(c, value)
    # a roll whose contracts have no bars stays by its own rows
    met = sides.join(rows, "symbol").unionByName(sides.withColumns({"_time": F.lit(None).cast("timestamp"), "_close": F.lit(None).cast("double")}))
    last = lambda n: F.max_by("_close", when(before & of(n), F.col("_time")))
    found = met.groupBy(*columns).agg(last(0).alias("front_price"), last(1).alias("_before"), F.min_by("_close", when(~before & of(1), F.col("_time"))).alias("_after"))
    return found.withColumn("back_price", F.coalesce("_before", "_after")).drop("_before", "_after")


def price_asof_roll(rolls: DataFrame, bars: DataFrame) -> DataFrame:
    """Front and back close at or before the day of each roll; the back falls forward where it has none before."""
    return prices_at(rolls, bars.withColumn("timestamp", day("timestamp")), "roll_date")


def missing_dates(reference: DataFrame, target: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(date, *by) that the reference has and the target has not."""
    dates = lambda df: df.select(day("timestamp").alias("date"), *by).where("date IS NOT NULL").distinct()
    return dates(reference).join(dates(target), ["date", *by], "left_anti")


def series_ratio(bars: DataFrame, a: str, b: str) -> DataFrame:
    """Two symbols' closes by date and their ratio, in one pass."""
    of = lambda s: F.max(F.when(F.col("symbol") == s, F.col("close")))
    both = bars.where(F.col("symbol").isin(a, b)).groupBy("timestamp").agg(of(a).alias("first"), of(b).alias("second")).where("first IS NOT NULL AND second IS NOT NULL")
    return both.withColumn("ratio", r(F.try_divide("first", "second")))


def basis(futures: DataFrame, index: DataFrame) -> DataFrame:
    """Each future's close less the index's on the date."""
    level = index.select("timestamp", F.col("close").alias("index_close"))
    out = futures.select("symbol", "timestamp", "close").join(level, "timestamp")
    return out.withColumn("basis", r(F.col("close") - F.col("index_close"))).withColumn("basis_pct", r(pct(F.col("close") - F.col("index_close"), F.col("index_close"))))


def with_indicators(bars: DataFrame, econ: DataFrame, names: list[str]) -> DataFrame:
    """Bars with the named indicators as columns, on equal timestamps."""
    wide = econ.groupBy("timestamp").pivot("indicator", names).agg(F.max("value"))
    return bars.join(wide, "timestamp", "left")


def wide_series(bars: DataFrame, symbols: list[str]) -> DataFrame:
    """One column of closes for each symbol, by date."""
    return bars.where(F.col("symbol").isin(symbols)).groupBy(day("timestamp").alias("date")).pivot("symbol", symbols).agg(F.max("close"))


def compare_series(a: DataFrame, b: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """Two tables' values side by side by date."""
    both = a.select("timestamp", F.lit(name_a).alias("origin"), "close").unionByName(b.select("timestamp", F.lit(name_b).alias("origin"), "close"))
    of = lambda s: F.max(F.when(F.col("origin") == s, F.col("close")))
    return both.groupBy(day("timestamp").alias("date")).agg(of(name_a).alias(name_a), of(name_b).alias(name_b))


def daily_to_intraday(ticks: DataFrame, daily: DataFrame, column: str, default: float = 1.0) -> DataFrame:
    """A daily value on each intraday row; rows before the first value take it, and rows without any the default."""
    joined = ticks.withColumn("date", day("timestamp")).join(daily.select("symbol", "date", column), ["symbol", "date"], "left")
    return joined.withColumn(column, F.coalesce(F.col(column), next_value(column), F.lit(default))).drop("date")


def rollover_context(rolls: DataFrame, bars: DataFrame) -> DataFrame:
    """Rolls with the closes of both contracts on their row before, on and after the roll date."""
    w = by_symbol()
    near = bars.select(
        "symbol", day("timestamp").alias("roll_date"), "close", F.lag("close").over(w).alias("prev_close"), F.lead("close").over(w).alias("next_close")
    )
    side = lambda name: near.select(F.col("symbol").alias(f"{name}_contract"), "roll_date", *(F.col(c).alias(f"{name}_{c}") for c in ("prev_close", "close", "next_close")))
    return rolls.join(side("from"), ["from_contract", "roll_date"], "left").join(side("to"), ["to_contract", "roll_date"], "left")
