"""Projections, filters and predicates over bars, ticks and accounts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebar.functions.scalars import change_pct, day, pct, r, recent, weekend

#: The relation of market data of each timeframe.
TIMEFRAMES = {"daily": "daily_bars", "minute": "minute_bars", "five_minute_bars": "five_minute_bars", "weekly": "weekly_bars", "monthly": "monthly_bars"}
#: Days that a read without dates goes back, and those for short bars.
DEFAULT_DAYS, SHORT_DAYS, SHORT = 30, 3, ("minute", "five_minute_bars")

OHLC = ("open", "high", "low", "close")


def retrieve(
    relation: DataFrame,
    fields: list[str] | None = None,
    symbols: list[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    aggregates: dict[str, str] | None = None,
    group_by: list[str] | None = None,
    order_by: list[str] | None = None,
    limit: int | None = None,
    default_days: int = DEFAULT_DAYS,
) -> DataFrame:
    """A read with parameters; without dates the last default_days up to the newest row."""
    df = relation
    if symbols:
        df = df.where(F.col("symbol").isin(symbols))
    if start or end:
        df = df.where((F.col("timestamp") >= F.lit(start).cast("timestamp")) if start else F.lit(True))
        df = df.where((F.col("timestamp") <= F.lit(end).cast("timestamp")) if end else F.lit(True))
    else:
        df = recent(df, default_days)
    if aggregates:
        df = df.groupBy(*(group_by or [])).agg(*(F.expr(f"{how}(`{c}`)").alias(f"{how}_{c}") for c, how in aggregates.items()))
    elif fields:
        df = df.select(*fields)
    if order_by:
        df = df.orderBy(*(F.col(c.lstrip("-")).desc() if c.startswith("-") else F.col(c) for c in order_by))
    return df.limit(limit) if limit else df


def relation_of(data_type: str, timeframe: str | None = None) -> str:
    """The name of the relation that holds a type of data: market data by timeframe, others under their own name."""
    return TIMEFRAMES.get(timeframe, "market_data") if data_type == "market_data" else data_type


def retrieve_from(catalog: Mapping[str, Callable[[], DataFrame]], data_type: str, timeframe: str | None = None, **parameters) -> DataFrame:
    """retrieve() from the relation of a type and timeframe; without dates short bars go back SHORT_DAYS. catalog: relations by name, made when asked for."""
    name = relation_of(data_type, timeframe)
    if name not in catalog:
        raise ValueError(f"no relation {name}; there are {', '.join(sorted(catalog))}")
    days = SHORT_DAYS if timeframe in SHORT else DEFAULT_DAYS
    return retrieve(catalog[name](), **{"default_days": days, **parameters})


def minute_bars(bars: DataFrame, value: int | None = None) -> DataFrame:
    of = F.col("interval_unit") == "minute"
    return bars.where(of & (F.col("interval_value") == value) if value else of)


def open_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status").isin("Open", "PartiallyFilled"))


def symbol_list(bars: DataFrame) -> DataFrame:
    return bars.select("symbol").distinct()


def symbols_like(bars: DataFrame, pattern: str) -> DataFrame:
    return symbol_list(bars.where(F.col("symbol").like(pattern)))


def symbols_regex(bars: DataFrame, pattern: str = "^[A-Z]{2,3}[FGHJKMNQUVXZ][0-9]{2}$") -> DataFrame:
    return symbol_list(bars.where(F.col("symbol").rlike(pattern)))


def low_quality(bars: DataFrame, below: int = 90) -> DataFrame:
    return bars.where((F.col("quality") < below) & (F.col("interval_unit") == "daily"))


def breaks_ohlc() -> Column:
    """high below another price, or low above one."""
    return F.expr("high < open OR high < close OR high < low OR low > open OR low > close")


def ohlc_inconsistent(bars: DataFrame) -> DataFrame:
    return bars.where(breaks_ohlc())


def price_validity(bars: DataFrame) -> DataFrame:
    """Rows with a bad price, each with the first error that fits."""
    error = F.expr(
        """CASE WHEN open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 THEN 'NON_POSITIVE_PRICE' WHEN high < low THEN 'HIGH_LESS_THAN_LOW'
        WHEN high < open OR high < close THEN 'HIGH_NOT_HIGHEST' WHEN low > open OR low > close THEN 'LOW_NOT_LOWEST' END"""
    )
    return bars.withColumn("error_type", error).where("error_type IS NOT NULL")


def volume_consistency(bars: DataFrame) -> DataFrame:
    issue = F.expr(
        "CASE WHEN volume < 0 THEN 'NEGATIVE_VOLUME' WHEN up_volume < 0 OR down_volume < 0 THEN 'NEGATIVE_COMPONENT' WHEN up_volume + down_volume <> volume THEN 'VOLUME_MISMATCH' END"
    )
    return bars.withColumn("issue", issue).where("issue IS NOT NULL")


def timestamp_validity(bars: DataFrame, first: int = 9, last: int = 16) -> DataFrame:
    hour = F.hour("timestamp")
    issue = F.when(weekend(F.col("timestamp")), "WEEKEND").when((hour < first) | (hour > last), "NON_MARKET_HOURS")
    return bars.withColumn("issue", issue).where("issue IS NOT NULL")


def zero_volume(bars: DataFrame) -> DataFrame:
    return bars.where("volume = 0 AND interval_unit = 'daily'")


def flat_price(bars: DataFrame) -> DataFrame:
    return bars.where("open = high AND high = low AND low = close AND volume > 0")


def sunday_rows(bars: DataFrame) -> DataFrame:
    return bars.where(F.weekday("timestamp") == 6)


def zero_prices(bars: DataFrame, price: str = "close") -> DataFrame:
    """Per symbol: rows with a zero or null price, first and last of them, and their share."""
    bad = F.col(price).isNull() | (F.col(price) == 0)
    return bars.groupBy("symbol").agg(
        F.count_if(bad).alias("zero_rows"),
        F.min(F.when(bad, F.col("timestamp"))).alias("first_zero"),
        F.max(F.when(bad, F.col("timestamp"))).alias("last_zero"),
        r(F.count_if(bad) * 100.0 / F.count("*")).alias("zero_pct"),
    ).where("zero_rows > 0")


def is_placeholder() -> Column:
    return F.expr("source = 'Placeholder' OR (coalesce(open, 0) = 0 AND coalesce(high, 0) = 0 AND coalesce(low, 0) = 0 AND coalesce(close, 0) = 0 AND coalesce(volume, 0) = 0)")


def drop_placeholders(bars: DataFrame) -> DataFrame:
    """Without placeholder rows, unless a symbol has no other."""
    others = F.count_if(~is_placeholder()).over(Window.partitionBy("symbol"))
    return bars.withColumn("_others", others).where(~is_placeholder() | (F.col("_others") == 0)).drop("_others")


def session_markers(ticks: DataFrame, start: str = "09:30", end: str = "16:00", entry_until: str = "15:30") -> DataFrame:
    time = F.date_format("timestamp", "HH:mm")
    inside = (time >= start) & (time < end)
    return ticks.withColumns({"trading_hour": inside, "pre_market": time < start, "post_market": time >= end, "can_enter": inside & (time < entry_until)})


def analysis_period(ticks: DataFrame, days: int = 10, buffer: int = 3) -> DataFrame:
    """Rows of the last days + buffer dates of a symbol; is_trading_period tells the buffer apart."""
    ranked = ticks.withColumn("_rank", F.dense_rank().over(Window.partitionBy("symbol").orderBy(day("timestamp").desc())))
    return ranked.where(F.col("_rank") <= days + buffer).withColumn("is_trading_period", F.col("_rank") <= days).drop("_rank")


def price_movement(bars: DataFrame, days: int = 30) -> DataFrame:
    moved = recent(bars, days)
    return moved.select(
        "symbol", "timestamp", "open", "high", "low", "close",
        r(pct(F.col("high") - F.col("low"), F.col("low"))).alias("range_pct"),
        r(change_pct(F.col("close"), F.col("open"))).alias("return_pct"),
        F.when(F.col("close") > F.col("open"), "UP").when(F.col("close") < F.col("open"), "DOWN").otherwise("FLAT").alias("direction"),
    )


def volume_analysis(bars: DataFrame, days: int = 30) -> DataFrame:
    up, down = F.col("up_volume"), F.col("down_volume")
    return recent(bars, days).select(
        "symbol", "timestamp", "volume", "up_volume", "down_volume",
        F.when(up > down, "UP").when(up < down, "DOWN").otherwise("NEUTRAL").alias("direction"),
        r(pct(up - down, F.col("volume"))).alias("imbalance_pct"),
    )


def valid_days(wide: DataFrame, required: list[str]) -> DataFrame:
    """Weekdays on which all required series have a value, with the number of such days in the year."""
    days = wide.dropna(subset=required).where(~weekend(F.col("date")))
    return days.select("date", F.date_format("date", "E").alias("weekday"), F.count("*").over(Window.partitionBy(F.year("date"))).alias("days_in_year"))


def changed_rows(bars: DataFrame, n: int = 20) -> DataFrame:
    """The newest rows that a repair has changed or filled (quality below 100)."""
    return bars.where("quality < 100").orderBy(F.col("timestamp").desc(), "symbol").limit(n)


def below_quality(bars: DataFrame, below: int = 100, n: int = 20) -> DataFrame:
    return bars.where(F.col("quality") < below).orderBy("quality", "timestamp", "symbol").limit(n)


def rows_between(ticks: DataFrame, start: str, end: str) -> DataFrame:
    return ticks.where(F.col("timestamp").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def drop_weekends(bars: DataFrame) -> DataFrame:
    return bars.where(~weekend(F.col("timestamp")))


def latest_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order)))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def top_n_per_group(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


