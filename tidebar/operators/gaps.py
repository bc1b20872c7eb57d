"""Gaps in series, and how much of the calendar they cover."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebar.functions.scalars import business_days_between, by_symbol, day, r, seconds, weekend


def gaps(bars: DataFrame, min_days: int = 1, start: str | None = None, end: str | None = None) -> DataFrame:
    """Stretches of over min_days days from one row to the next, with the days missing in between."""
    days = bars.select("symbol", day("timestamp").alias("gap_start"))
    if start:
        days = days.where(F.col("gap_start") >= start)
    if end:
        days = days.where(F.col("gap_start") <= end)
    out = days.withColumn("gap_end", F.lead("gap_start").over(by_symbol("gap_start")))
    return out.withColumn("gap_days", (F.datediff("gap_end", "gap_start") - 1).cast("long")).where(F.col("gap_days") >= min_days)


def holiday_array(holidays: Sequence[str]):
    return F.array(*(F.lit(h).cast("date") for h in holidays))


def gaps_business(bars: DataFrame, holidays: Sequence[str] = ()) -> DataFrame:
    """Gaps with missing days that are neither at weekends nor holidays."""
    missing = business_days_between(F.col("gap_start"), F.col("gap_end"))
    if holidays:
        inside = F.filter(holiday_array(holidays), lambda h: (h > F.col("gap_start")) & (h < F.col("gap_end")) & (F.weekday(h) < 5))
        missing = missing - F.size(inside)
    return gaps(bars).withColumn("missing_days", missing.cast("long")).where("missing_days > 0")


def gap_summary(bars: DataFrame, holidays: Sequence[str] = ()) -> DataFrame:
    return gaps_business(bars, holidays).groupBy("symbol").agg(
        F.count("*").alias("gaps"), F.sum("missing_days").alias("total_missing"), r(F.avg("missing_days")).alias("avg_missing"), F.max("missing_days").alias("max_missing")
    )


def recent_gaps(bars: DataFrame, days: int = 90) -> DataFrame:
    newest = bars.agg(day(F.max("timestamp")).alias("as_of"))
    return gaps_business(bars).crossJoin(F.broadcast(newest)).where(F.col("gap_end") >= F.date_sub("as_of", days)).drop("as_of")


def time_continuity(bars: DataFrame) -> DataFrame:
    after = F.lead("timestamp").over(by_symbol())
    out = bars.select("symbol", "timestamp", after.alias("next_timestamp"))
    return out.withColumn("gap", r((seconds("next_timestamp") - seconds("timestamp")) / 86400)).where("gap > 1")


def calendar_days(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """All dates from the first to the last of a column; one row is exploded on the executors."""
    return df.agg(day(F.min(column)).alias("a"), day(F.max(column)).alias("b")).where("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("date"))


def coverage(bars: DataFrame, holidays: Sequence[str] = ()) -> DataFrame:
    """Distinct days of each symbol against the business days of the whole range."""
    business = calendar_days(bars).where(~weekend(F.col("date")))
    if holidays:
        business = business.where(~F.array_contains(holiday_array(holidays), F.col("date")))
    expected = business.agg(F.count("*").alias("expected_days"))
    return (
        bars.groupBy("symbol").agg(F.count_distinct(day("timestamp")).alias("actual_days")).crossJoin(F.broadcast(expected))
        .withColumn("coverage_pct", r(F.try_divide(F.col("actual_days") * 100.0, F.col("expected_days"))))
    )


def interval_gaps(bars: DataFrame, interval_seconds: int, factor: float = 1.5) -> DataFrame:
    """Steps longer than factor times the expected interval, with an estimate of the points missing."""
    after = F.lead("timestamp").over(by_symbol())
    out = bars.select("symbol", F.col("timestamp").alias("gap_start"), after.alias("gap_end"))
    out = out.withColumn("duration_s", r(seconds("gap_end") - seconds("gap_start"))).where(F.col("duration_s") > factor * interval_seconds)
    return out.withColumn("missing_points", (F.round(F.col("duration_s") / interval_seconds) - 1).cast("long"))


def intraday_gaps(ticks: DataFrame, minutes: int = 30) -> DataFrame:
    before = F.lag("timestamp").over(by_symbol())
    out = ticks.select("symbol", before.alias("previous"), "timestamp")
    return out.withColumn("gap_minutes", r((seconds("timestamp") - seconds("previous")) / 60)).where(F.col("gap_minutes") > minutes)


def missing_business_days(bars: DataFrame) -> DataFrame:
    """Weekdays within a symbol's range on which it has no row."""
    days = bars.groupBy("symbol").agg(day(F.min("timestamp")).alias("a"), day(F.max("timestamp")).alias("b"))
    wanted = days.select("symbol", F.explode(F.sequence("a", "b")).alias("date")).where(~weekend(F.col("date")))
    return wanted.join(bars.select("symbol", day("timestamp").alias("date")), ["symbol", "date"], "left_anti")


def trading_day_gaps(bars: DataFrame, calendar: DataFrame, max_gap: int = 2) -> DataFrame:
    """Gaps with more than max_gap trading days strictly between; calendar: (date, ordinal), broadcast as a calendar is small."""
    days = bars.select("symbol", day("timestamp").alias("date")).distinct().join(F.broadcast(calendar), "date")
    w = by_symbol("date")
    out = days.select("symbol", F.col("date").alias("gap_start"), F.lead("date").over(w).alias("gap_end"), (F.lead("ordinal").over(w) - F.col("ordinal") - 1).cast("long").alias("trading_days"))
    return out.where(F.col("trading_days") > max_gap)


def missing_contracts(bars: DataFrame, expected: DataFrame) -> DataFrame:
    return expected.select("symbol").distinct().join(bars.select("symbol").distinct(), "symbol", "left_anti")


def missing_vs_reference(reference: DataFrame, series: DataFrame, n: int) -> DataFrame:
    """(root, date, position) for which the reference (date, value) has a value and a root's series (root, date, position, value) has not."""
    roots = series.select("root").distinct()  # a handful: each meets the dates of the reference
    dates = reference.where("value IS NOT NULL").select("date").distinct()
    wanted = dates.crossJoin(F.broadcast(roots)).select("root", "date", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("position"))
    missing = wanted.join(series.where("value IS NOT NULL"), ["root", "date", "position"], "left_anti")
    return missing.withColumns({"weekday": F.date_format("date", "E"), "month": F.month("date")})


def missing_intervals(bars: DataFrame, config: DataFrame) -> DataFrame:
    return config.join(bars.select("symbol", "interval_unit").distinct(), ["symbol", "interval_unit"], "left_anti")


