"""Technical indicators: windows by symbol, the recursive ones unrolled into windows."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebar.functions.scalars import by_symbol, day, guarded, last_rows, r


#: What a mean still owes to values before its chunk and the one before it, at most: below the precision of doubles.
FORGOTTEN = 1e-30


def _ewm(df: DataFrame, new: str, column: str, alpha: float, key: str, order: Sequence[str]) -> DataFrame:
    """One exponentially weighted mean by windows alone.

    Values are counted, and chunks of so many are taken that a whole chunk's decay is FORGOTTEN. Within a chunk the mean
    is decay^i times a running sum of alpha x / decay^i; what the chunk before ended with decays on in it.
    """
    decay = 1.0 - alpha
    length = max(1, math.ceil(math.log(FORGOTTEN) / math.log(decay))) if 0 < decay < 1 else 1
    by_key = Window.partitionBy(key).orderBy(*order)
    x, known = F.col(column).cast("double"), F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))
    out = df.withColumn("_k", F.count(F.when(known, F.lit(1))).over(by_key.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    place = F.pmod("_k", F.lit(length)).cast("double")
    weighted = F.when(known, x * F.when(F.col("_k") == 0, 1.0).otherwise(alpha) / F.pow(F.lit(decay), place))
    chunk = Window.partitionBy(key, F.floor(F.col("_k") / length)).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("_own", F.when(known, F.sum(weighted).over(chunk) * F.pow(F.lit(decay), place)))
    before = F.last(F.when(known & (F.pmod("_k", F.lit(length)) == length - 1), F.col("_own")), ignorenulls=True).over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    mean = F.col("_own") + F.coalesce(before, F.lit(0.0)) * F.pow(F.lit(decay), place + 1)
    out = out.withColumn(new, mean)  # of rows with a value
    return out.withColumn(new, F.last(new, ignorenulls=True).over(by_key.rowsBetween(Window.unboundedPreceding, 0))).drop("_k", "_own")


def ewm(df: DataFrame, columns: dict[str, tuple[str, float]], key: str = "symbol", order: str | Sequence[str] = "timestamp") -> DataFrame:
    """df with exponentially weighted means: {new column: (column, alpha)}, e0 = x0, e = e + alpha (x - e); 0 < alpha <= 1.

    Nulls (and NaN) keep the value before. A later column may smooth an earlier new one. The recursion is unrolled into
    windows by key, which spill, so that no series is held in memory as a whole.
    """
    for new, (column, alpha) in columns.items():
        df = _ewm(df, new, column, alpha, key, (order,) if isinstance(order, str) else tuple(order))
    return df


def alpha(span: int) -> float:
    return 2.0 / (span + 1)


def sma(bars: DataFrame, n: int = 20, column: str = "close") -> DataFrame:
    w = last_rows(n)
    return bars.withColumn(f"sma_{n}", guarded(n, F.avg(column).over(w), F.col(column), w))


def ema(bars: DataFrame, span: int = 20, column: str = "close") -> DataFrame:
    return ewm(bars, {f"ema_{span}": (column, alpha(span))})


def rsi(bars: DataFrame, n: int = 14) -> DataFrame:
    """Relative strength from simple means of gains and losses; 100 without losses, null without moves."""
    w = last_rows(n)
    moved = bars.withColumn("_move", F.col("close") - F.lag("close").over(by_symbol()))
    # greatest() skips nulls, so the first row counts as no move; the guard below leaves its windows out
    means = {"_gain": F.avg(F.greatest("_move", F.lit(0.0))).over(w), "_loss": F.avg(F.greatest(-F.col("_move"), F.lit(0.0))).over(w), "_moves": F.count("_move").over(w)}
    gain, loss = F.col("_gain"), F.col("_loss")
    value = F.when(loss == 0, F.when(gain > 0, 100.0)).otherwise(100 - 100 / (1 + gain / loss))
    return moved.withColumns(means).withColumn(f"rsi_{n}", F.when(F.col("_moves") >= n, value)).drop("_move", *means)


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """The difference of a fast and a slow mean, its own mean, and the rest."""
    out = ewm(bars, {"_fast": ("close", alpha(fast)), "_slow": ("close", alpha(slow))}).withColumn("macd", F.col("_fast") - F.col("_slow"))
    out = ewm(out, {"macd_signal": ("macd", alpha(signal))})
    return out.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")).drop("_fast", "_slow")


def bollinger(bars: DataFrame, n: int = 20, k: float = 2.0) -> DataFrame:
    w = last_rows(n)
    sums = {"_mean": F.avg("close").over(w), "_std": F.stddev_samp("close").over(w), "_n": F.count("close").over(w)}
    mean, spread = (F.when(F.col("_n") >= n, F.col(c)) for c in ("_mean", "_std"))
    return bars.withColumns(sums).withColumns({"bb_middle": mean, "bb_upper": mean + k * spread, "bb_lower": mean - k * spread}).drop(*sums)


def true_range() -> Column:
    before = F.lag("close").over(by_symbol())
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def atr(bars: DataFrame, n: int = 14) -> DataFrame:
    w = last_rows(n)
    return bars.withColumn("_range", true_range()).withColumn(f"atr_{n}", guarded(n, F.avg("_range").over(w), F.col("_range"), w)).drop("_range")


def stochastic(bars: DataFrame, k: int = 14, slow: int = 3, d: int = 3) -> DataFrame:
    w = last_rows(k)
    low, high = F.min("low").over(w), F.max("high").over(w)
    out = bars.withColumns({"_low": low, "_high": high, "_n": F.count("close").over(w)})
    raw = F.try_divide(100.0 * (F.col("close") - F.col("_low")), F.col("_high") - F.col("_low"))
    out = out.withColumn("_raw", F.when(F.col("_n") >= k, raw)).drop("_low", "_high", "_n")
    ws, wd = last_rows(slow), last_rows(d)
    out = out.withColumn("stoch_k", guarded(slow, F.avg("_raw").over(ws), F.col("_raw"), ws))
    return out.withColumn("stoch_d", guarded(d, F.avg("stoch_k").over(wd), F.col("stoch_k"), wd)).drop("_raw")


#: name -> (function of bars, its columns, its parameters): what a caller may add to.
INDICATORS: dict[str, tuple[Callable[[DataFrame], DataFrame], list[str], dict[str, float]]] = {
    "sma": (lambda b: sma(b, 20), ["sma_20"], {"n": 20}),
    "ema": (lambda b: ema(b, 20), ["ema_20"], {"span": 20}),
    "rsi": (lambda b: rsi(b, 14), ["rsi_14"], {"n": 14}),
    "macd": (macd, ["macd", "macd_signal", "macd_histogram"], {"fast": 12, "slow": 26, "signal": 9}),
    "bollinger": (bollinger, ["bb_middle", "bb_upper", "bb_lower"], {"n": 20, "k": 2}),
    "atr": (atr, ["atr_14"], {"n": 14}),
    "stochastic": (stochastic, ["stoch_k", "stoch_d"], {"k": 14, "slow": 3, "d": 3}),
}


def indicators_long(bars: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(timestamp, symbol, indicator_name, value, parameters): chosen indicators, one row for each value."""
    df, columns = bars, {}
    for name in names or INDICATORS:
        f, made, parameters = INDICATORS[name]
        df = f(df)
        columns |= dict.fromkeys(made, parameters)
    to_json = lambda p: F.to_json(F.create_map(*(x for k, v in p.items() for x in (F.lit(k), F.lit(float(v))))))
    rows = F.array(*(F.struct(F.lit(c).alias("indicator_name"), F.col(c).cast("double").alias("value"), to_json(p).alias("parameters")) for c, p in columns.items()))
    return df.select("timestamp", "symbol", F.inline(rows)).where("value IS NOT NULL")


def noise_bands(ticks: DataFrame, lookback: int = 14, mult: float = 1.0) -> DataFrame:
    """Bands around the open that the usual move of this hour of the day widens; ticks: hourly bars."""
    by_day = Window.partitionBy("symbol", day("timestamp")).orderBy("timestamp").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = ticks.withColumn("day_open", F.first("open").over(by_day)).withColumn("day_close", F.last("close").over(by_day)).withColumn("date", day("timestamp"))
    last = df.select("symbol", "date", "day_close").distinct().withColumn("prev_close", F.lag("day_close").over(Window.partitionBy("symbol").orderBy("date")))
    df = df.join(last.select("symbol", "date", "prev_close"), ["symbol", "date"]).drop("day_close", "date")
    df = df.withColumn("move", F.abs(F.try_divide(F.col("close"), F.col("day_open")) - 1)).withColumn("slot", F.hour("timestamp"))
    w = Window.partitionBy("symbol", "slot").orderBy("timestamp").rowsBetween(-lookback + 1, 0)
    df = df.withColumn("avg_move", guarded(max(5, lookback // 4), F.avg("move").over(w), F.col("move"), w))
    df = df.withColumn("avg_move", F.last("avg_move", ignorenulls=True).over(by_symbol().rowsBetween(Window.unboundedPreceding, 0)))
    up = F.greatest("day_open", "prev_close") * (1 + mult * F.col("avg_move"))
    low = F.least("day_open", "prev_close") * (1 - mult * F.col("avg_move"))
    return df.withColumns({"upper": F.greatest(up, low), "lower": F.least(up, low)}).drop("slot")


def breakout_signals(bands: DataFrame, minutes: Sequence[int] = (0, 30), opens: str = "09:30", last_entry: str = "15:30", closes: str = "16:00", invert: bool = False) -> DataFrame:
    """1 above the upper band, -1 below the lower one, at these minutes of the hour from the open to the last entry (inclusive); inverted on demand.

    stop: the vwap (a column of bands, if there is one) from the open to the close, else null.
    """
    time = F.date_format("timestamp", "HH:mm")
    able = F.minute("timestamp").isin(list(minutes)) & time.between(opens, last_entry)
    signal = F.when(able & (F.col("close") > F.col("upper")), 1).when(able & (F.col("close") < F.col("lower")), -1).otherwise(0)
    stop = F.when(time.between(opens, closes), F.col("vwap")) if "vwap" in bands.columns else F.lit(None).cast("double")
    return bands.withColumns({"signal": -signal if invert else signal, "stop": stop})


def signal_counts(signals: DataFrame) -> DataFrame:
    return signals.groupBy("symbol", "signal").agg(F.count("*").alias("n"))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("symbol", "timestamp", *(r(F.col(c)).alias(c) for c in columns))
