"""Window operators: one shuffle by symbol, in order of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebar.functions.scalars import by_symbol, change_pct, day, guarded, last_rows, pct, r, recent
from tidebar.operators.scans import running


def market_statistics(bars: DataFrame, days: int = 30) -> DataFrame:
    """Change against the row before, and how strong it is with the volume's change."""
    w = by_symbol()
    price, volume = change_pct(F.col("close"), F.lag("close").over(w)), change_pct(F.col("volume"), F.lag("volume").over(w))
    moved = bars.withColumns({"price_change_pct": price, "volume_change_pct": volume})
    label = F.expr(
        """CASE WHEN price_change_pct > 0 AND volume_change_pct > 0 THEN 'STRONG_UP' WHEN price_change_pct > 0 THEN 'WEAK_UP'
        WHEN price_change_pct < 0 AND volume_change_pct > 0 THEN 'STRONG_DOWN' WHEN price_change_pct < 0 THEN 'WEAK_DOWN' ELSE 'NEUTRAL' END"""
    )
    return recent(moved.withColumn("label", label), days).select("symbol", "timestamp", "close", r("price_change_pct").alias("price_change_pct"), r("volume_change_pct").alias("volume_change_pct"), "label")


def momentum(bars: DataFrame, lags: tuple[int, ...] = (5, 10, 20), days: int = 30) -> DataFrame:
    w = by_symbol()
    out = bars.withColumns({f"momentum_{n}": r(change_pct(F.col("close"), F.lag("close", n).over(w))) for n in lags})
    return recent(out, days).select("symbol", "timestamp", "close", *(f"momentum_{n}" for n in lags))


def log_return(column: str = "close") -> Column:
    before = F.lag(column).over(by_symbol())
    return F.when((F.col(column) > 0) & (before > 0), F.ln(F.col(column) / before))


def rolling_volatility(bars: DataFrame, n: int = 20) -> DataFrame:
    """Annualised deviation of log returns over n rows; short windows at the start count too."""
    out = bars.withColumn("log_return", log_return())
    return out.select("symbol", "timestamp", r(F.stddev_samp("log_return").over(last_rows(n)) * F.sqrt(F.lit(252.0))).alias("volatility"))


def depth_stats(bars: DataFrame, days: int = 30) -> DataFrame:
    spread = pct(F.col("high") - F.col("low"), F.col("close"))
    trend = F.col("volume") - F.lag("volume").over(by_symbol())
    out = bars.withColumns({"spread_pct": r(spread), "volume_trend": trend})
    label = F.when(F.col("spread_pct") < 1, "TIGHT").when(F.col("spread_pct") < 5, "NORMAL").otherwise("WIDE")
    return recent(out.withColumn("depth", label), days).select("symbol", "timestamp", "spread_pct", "volume_trend", "depth")


def price_jumps(bars: DataFrame, threshold_pct: float = 5.0) -> DataFrame:
    out = bars.withColumn("change_pct", r(change_pct(F.col("close"), F.lag("close").over(by_symbol()))))
    return out.where(F.abs("change_pct") > threshold_pct).select("symbol", "timestamp", "close", "change_pct")


def rollover_events(cont: DataFrame, key: str = "root", underlying: str = "underlying_symbol") -> DataFrame:
    """The rows on which a continuous series passes to another contract."""
    before = F.lag(underlying).over(by_symbol(key=key))
    return cont.withColumn("from_contract", before).where(F.col("from_contract") != F.col(underlying)).select(key, "timestamp", "from_contract", F.col(underlying).alias("to_contract"))


def preferred_roll_dedup(rolls: DataFrame, preferred: str = "volume") -> DataFrame:
    """One roll for a root, contract and date, of the preferred type if there is one; with the contract that follows."""
    rank = F.row_number().over(Window.partitionBy("root", "contract", "roll_date").orderBy(F.when(F.col("roll_type") == preferred, 0).otherwise(1), "roll_type"))
    kept = rolls.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return kept.withColumn("to_contract", F.lead("contract").over(Window.partitionBy("root").orderBy("roll_date", "contract")))


def centred_band(bars: DataFrame, column: str = "close", before: int = 20, after: int = 20) -> DataFrame:
    w = by_symbol().rowsBetween(-before, after)
    return bars.withColumns({"band_mean": F.avg(column).over(w), "band_std": F.stddev_samp(column).over(w)})


def partition_zscore(df: DataFrame, column: str) -> DataFrame:
    w = Window.partitionBy("symbol")
    return df.withColumn("zscore", F.try_divide(F.col(column) - F.avg(column).over(w), F.stddev_samp(column).over(w)))


def neighbour_midpoint(bars: DataFrame, column: str) -> DataFrame:
    """Nulls filled with the middle of the rows before and after."""
    w = by_symbol()
    return bars.withColumn(column, F.coalesce(F.col(column), (F.lag(column).over(w) + F.lead(column).over(w)) / 2))


def source_transition(series: DataFrame) -> DataFrame:
    before = F.lag("source").over(by_symbol())
    return series.withColumn("changed", ~F.col("source").eqNullSafe(before) & before.isNotNull())


def intraday_vwap(ticks: DataFrame, start: str = "09:30", end: str = "16:00", tie: str = "id") -> DataFrame:
    """Running volume-weighted price of a day within the session, else the close."""
    time = F.date_format("timestamp", "HH:mm")
    inside = (time >= start) & (time < end)
    w = Window.partitionBy("symbol", day("timestamp")).orderBy("timestamp", tie).rowsBetween(Window.unboundedPreceding, 0)
    value, volume = F.sum(F.when(inside, F.col("close") * F.col("volume"))).over(w), F.sum(F.when(inside, F.col("volume"))).over(w)
    return ticks.withColumn("vwap", F.when(inside, F.try_divide(value, volume)).otherwise(F.col("close")))


def running_peak(df: DataFrame, column: str) -> DataFrame:
    return running(df, {"peak": ("max", F.col(column))})


def running_product(df: DataFrame, returns: str) -> DataFrame:
    return running(df, {"growth": ("product", 1 + F.coalesce(returns, F.lit(0.0)))})


def fill(df: DataFrame, columns: list[str], direction: str = "forward") -> DataFrame:
    """Nulls from the nearest value before (forward) or after (backward)."""
    out = running(df, {c: ("last", F.col(c)) for c in columns}, falling=direction != "forward")
    return out.select(*df.columns)


def seasonal_rolling_mean(bars: DataFrame, column: str, days: int = 14, slot: Column | None = None) -> DataFrame:
    """Mean of a column over the last days at the same minute of the day, from max(5, days / 4) values on."""
    minute = F.hour("timestamp") * 60 + F.minute("timestamp") if slot is None else slot
    w = Window.partitionBy("symbol", "minute_of_day").orderBy("timestamp").rowsBetween(-days + 1, 0)
    return bars.withColumn("minute_of_day", minute).withColumn("seasonal_mean", guarded(max(5, days // 4), F.avg(column).over(w), F.col(column), w))
