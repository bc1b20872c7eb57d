"""Resampling and grouped aggregation of bars and ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebar.functions.calendars import holiday_label
from tidebar.functions.scalars import by_symbol, day, r, recent


def bucket(width: str) -> Column:
    """The start of the bar that holds timestamp: a unit (day, week, month) or a length (5 minutes)."""
    if width in ("hour", "day", "week", "month"):
        return F.date_trunc(width, "timestamp")
    n, unit = width.split()
    size = int(n) * {"minute": 60, "hour": 3600, "second": 1}[unit.rstrip("s")]
    return F.timestamp_seconds(F.floor(F.unix_timestamp("timestamp") / size) * size)


def resample(bars: DataFrame, width: str, *more_keys: str, tie: str | None = None) -> DataFrame:
    """Bars of a wider interval; first and last by timestamp, ties by the column tie."""
    order = F.struct("timestamp", tie) if tie else F.col("timestamp")
    return (
        bars.groupBy("symbol", *more_keys, bucket(width).alias("bucket"))
        .agg(F.min_by("open", order).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", order).alias("close"), F.sum("volume").alias("volume"))
        .withColumnRenamed("bucket", "timestamp")
    )


def resample_last(ticks: DataFrame, tie: str = "id") -> DataFrame:
    """The last close of each day."""
    return ticks.groupBy("symbol", day("timestamp").alias("date")).agg(F.max_by("close", F.struct("timestamp", tie)).alias("close"))


def session_stats(ticks: DataFrame, days: int = 30) -> DataFrame:
    return recent(ticks, days).groupBy("symbol", day("timestamp").alias("date"), F.hour("timestamp").alias("hour")).agg(
        F.count("*").alias("n"), F.sum("volume").alias("volume"), r(F.avg("close")).alias("avg_close"), r(F.max("high") - F.min("low")).alias("range")
    )


def market_breadth(bars: DataFrame, days: int = 30) -> DataFrame:
    of = lambda cond: F.count_distinct(F.when(F.expr(cond), F.col("symbol")))
    counted = recent(bars, days).groupBy("timestamp").agg(
        F.count_distinct("symbol").alias("total"), of("close > open").alias("advancing"), of("close < open").alias("declining"), of("close = open").alias("unchanged")
    )
    return counted.withColumn("ratio", r(F.try_divide(F.col("advancing").cast("double"), F.col("declining"))))


def price_decile(bars: DataFrame, n: int = 10) -> DataFrame:
    return bars.withColumn("decile", F.ntile(n).over(by_symbol("close", "timestamp")))


def price_distribution(bars: DataFrame, n: int = 10, days: int = 365) -> DataFrame:
    return price_decile(recent(bars, days), n).groupBy("symbol", "decile").agg(
        F.min("close").alias("min_close"), F.max("close").alias("max_close"), r(F.avg("close")).alias("avg_close"), F.count("*").alias("n")
    )


def inventory(bars: DataFrame, *keys: str) -> DataFrame:
    """First and last date, rows and days spanned of each group."""
    return bars.groupBy(*keys).agg(
        day(F.min("timestamp")).alias("first_date"), day(F.max("timestamp")).alias("last_date"), F.count("*").alias("n"),
        F.datediff(F.max("timestamp"), F.min("timestamp")).cast("long").alias("span_days"),
    )


def stale_symbols(bars: DataFrame, days: int = 7) -> DataFrame:
    newest = bars.agg(F.max("timestamp").alias("as_of"))
    return inventory(bars, "symbol").crossJoin(F.broadcast(newest)).where(F.datediff("as_of", "last_date") > days).drop("as_of")


def recent_symbols(bars: DataFrame, n: int = 20) -> DataFrame:
    return bars.groupBy("symbol").agg(F.max("timestamp").alias("last")).orderBy(F.col("last").desc(), "symbol").limit(n)


def interval_counts(bars: DataFrame) -> DataFrame:
    return bars.groupBy("interval_value", "interval_unit").agg(F.count_distinct("symbol").alias("symbols"), F.count("*").alias("n"))


def monthly_density(bars: DataFrame) -> DataFrame:
    return bars.groupBy(F.date_trunc("month", "timestamp").alias("month")).agg(F.count_distinct("symbol").alias("symbols"), F.count("*").alias("n"))


def contract_details(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(
        F.count("*").alias("n"), day(F.min("timestamp")).alias("first_date"), day(F.max("timestamp")).alias("last_date"), r(F.avg(F.col("high") - F.col("low")), 4).alias("avg_range")
    )


def purge_candidates(bars: DataFrame, before_year: int, fewer_than: int, pattern: str) -> DataFrame:
    """Contracts by the reason for which they may be deleted."""
    spans = inventory(bars, "symbol").where(F.col("symbol").rlike(pattern))
    reason = F.when(F.year("last_date") < before_year, "OLD").when(F.col("n") < fewer_than, "FEW_ROWS")
    return spans.withColumn("reason", reason).where("reason IS NOT NULL")


def series_completeness(cont: DataFrame, n: int) -> DataFrame:
    """Per root and date: how many of the positions 1..n are there, which, and whether all."""
    here = F.col("position").between(1, n)
    return cont.groupBy("root", "date").agg(
        F.count_distinct(F.when(here, F.col("position"))).alias("present"),
        F.array_join(F.sort_array(F.collect_set(F.when(here, F.col("position").cast("string")))), ",").alias("positions"),
    ).withColumn("complete", F.col("present") == n)


def missing_patterns(missing: DataFrame) -> DataFrame:
    """Counts of missing dates by year, month, weekday and holiday (`none` for other days), in one pass of grouping sets."""
    holiday = F.coalesce(holiday_label(F.col("date")), F.lit("none"))
    parts = missing.select(F.year("date").alias("year"), F.month("date").alias("month"), F.weekday("date").alias("weekday"), holiday.alias("holiday"))
    counted = parts.groupingSets([["year"], ["month"], ["weekday"], ["holiday"]], "year", "month", "weekday", "holiday").agg(F.count("*").alias("n"))
    return counted.fillna(-1, ["year", "month", "weekday"]).fillna("", ["holiday"])  # -1 and "": over all


def trades_daily(trades: DataFrame, initial: float = 100_000.0) -> DataFrame:
    """Daily result, costs, win rate, and the equity curve with its peak and drawdown."""
    daily = trades.groupBy("date").agg(
        F.sum("pnl").alias("pnl"), F.sum("costs").alias("costs"), F.count("*").alias("trades"), r(F.avg((F.col("pnl") > F.col("costs")).cast("double"))).alias("win_rate")
    )
    w = Window.orderBy("date")  # one row a day
    daily = daily.withColumn("equity", F.lit(initial) + F.sum(F.col("pnl") - F.col("costs")).over(w))
    daily = daily.withColumn("return", F.try_divide(F.col("equity"), F.coalesce(F.lag("equity").over(w), F.lit(initial))) - 1).withColumn("peak", F.max("equity").over(w))
    return daily.select(
        "date", r("pnl", 2).alias("pnl"), r("costs", 2).alias("costs"), "trades", "win_rate", r("equity", 2).alias("equity"), r("return").alias("return"), r("peak", 2).alias("peak"),
        r(F.try_divide(F.col("equity"), F.col("peak")) - 1).alias("drawdown"),
    )


def position_daily(ticks: DataFrame, tie: str = "id") -> DataFrame:
    """Per day: last, greatest and mean size of the non-zero position."""
    p = F.col("position")
    return ticks.groupBy("symbol", day("timestamp").alias("date")).agg(
        F.max_by(p, F.struct("timestamp", tie)).alias("last_position"), F.max(F.abs(p)).alias("max_position"), r(F.avg(F.when(p != 0, F.abs(p)))).alias("avg_position")
    )


def key_uniqueness(bars: DataFrame, keys: list[str]) -> DataFrame:
    return bars.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def yearly_counts(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol", F.year("timestamp").alias("year")).agg(F.count("*").alias("n"))


def latest_prices(bars: DataFrame) -> DataFrame:
    last = bars.groupBy("symbol").agg(F.max_by(F.struct("timestamp", "close", "volume"), "timestamp").alias("last"))
    return last.select("symbol", "last.*")


def daily_open_close(ticks: DataFrame, tie: str = "id") -> DataFrame:
    order = F.struct("timestamp", tie)
    daily = ticks.groupBy("symbol", day("timestamp").alias("date")).agg(F.min_by("open", order).alias("open"), F.max_by("close", order).alias("close"))
    return daily.withColumn("prev_close", F.lag("close").over(by_symbol("date")))


def avg_volume(bars: DataFrame, width: str = "month") -> DataFrame:
    return bars.groupBy("symbol", F.date_trunc(width, "timestamp").alias("period")).agg(r(F.avg("volume")).alias("avg_volume"))


def extremes(bars: DataFrame, width: str = "week") -> DataFrame:
    return bars.groupBy("symbol", F.date_trunc(width, "timestamp").alias("period")).agg(F.max("high").alias("highest"), F.min("low").alias("lowest"))


def symbol_statistics(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(
        F.count("*").alias("n"), F.count_distinct(day("timestamp")).alias("days"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )


def roll_dates_summary(rolls: DataFrame) -> DataFrame:
    return rolls.groupBy("root", "roll_type").agg(F.count("*").alias("n"), F.min("roll_date").alias("first_roll"), F.max("roll_date").alias("last_roll"))


