"""Returns, performance, portfolio and risk analytics.

returns: symbol, timestamp, ret; a null return counts as 0 where the measure says so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebar.functions.quantiles import joined, percentiles
from tidebar.functions.scalars import bias_corrected_kurtosis, bias_corrected_skew, by_symbol, guarded, last_rows, r
from tidebar.operators.indicators import ewm
from tidebar.operators.pairs import pairs_by_date

YEAR = 252.0
#: Rows that a period looks back.
PERIODS = {"daily": 1, "weekly": 5, "monthly": 21, "yearly": 252}


def returns(bars: DataFrame, period: str = "daily") -> DataFrame:
    """Change over the period's rows, log return, and the growth of daily returns so far."""
    w = by_symbol()
    valid = bars.where("close IS NOT NULL")
    ret = F.try_divide(F.col("close"), F.lag("close", PERIODS[period]).over(w)) - 1
    step = F.try_divide(F.col("close"), F.lag("close").over(w))
    out = valid.withColumns({"ret": ret, "log_return": F.when(step > 0, F.ln(step)), "_step": F.coalesce(step, F.lit(1.0))})
    grown = F.product("_step").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1
    return out.withColumn("cumulative", grown).select("symbol", "timestamp", "close", "ret", "log_return", "cumulative")


def _curve(rets: DataFrame, key: Sequence[str] = ("symbol",)) -> DataFrame:
    """Equity, its peak and drawdown; the first return counts as 0."""
    w = Window.partitionBy(*key).orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    df = rets.withColumn("ret", F.coalesce("ret", F.lit(0.0)))
    df = df.withColumn("equity", F.product(1 + F.col("ret")).over(w))
    df = df.withColumn("peak", F.max("equity").over(w))
    return df.withColumn("drawdown", F.try_divide("equity", "peak") - 1)


def _ratio(mean: Column, deviation: Column) -> Column:
    return F.try_divide(mean * YEAR, deviation * F.sqrt(F.lit(YEAR)))


def _with_percentiles(out: DataFrame, rets: DataFrame, shares: Sequence[int]) -> DataFrame:
    """out, a row for each symbol, with p1, p5, … of the symbol's returns."""
    found = percentiles(rets, ["symbol"], {"_q": F.col("ret")}, [p / 100 for p in shares])
    return joined(out, found, ["symbol"]).withColumns({f"p{p}": r(F.col("_q")[k]) for k, p in enumerate(shares)}).drop("_q")


def performance(rets: DataFrame, rf: float = 0.0) -> DataFrame:
    """One row of measures for each symbol with two returns or more."""
    df = _curve(rets)
    ret, n = F.col("ret"), F.count("ret")
    excess = F.avg("ret") - rf / YEAR
    years = F.greatest(F.datediff(F.max("timestamp"), F.min("timestamp")) / 365.0, F.lit(0.01))
    total = F.max_by("equity", "timestamp") - 1
    out = df.groupBy("symbol").agg(
        n.alias("n"), r(total).alias("total_return"), r(F.pow(1 + total, 1 / years) - 1).alias("cagr"), r(F.stddev_samp(ret) * F.sqrt(F.lit(YEAR))).alias("volatility"),
        r(F.min("drawdown")).alias("max_drawdown"), r(_ratio(excess, F.stddev_samp(ret))).alias("sharpe"), r(_ratio(excess, F.stddev_samp(F.when(ret < 0, ret)))).alias("sortino"),
        r(bias_corrected_skew(ret, n), 4).alias("skew"), r(bias_corrected_kurtosis(ret, n), 4).alias("kurtosis"),
        r(F.avg((ret > 0).cast("double"))).alias("positive_share"), r(F.avg(ret)).alias("mean"),
    )
    return _with_percentiles(out.where("n >= 2"), df, (5, 10, 25, 50, 75, 90)).withColumnsRenamed({"p5": "var_95", "p50": "median"})


def correlation(rets: DataFrame) -> DataFrame:
    """(symbol, other, correlation) of all pairs, a missing return of a common date counting as 0.

    From sums over the dates on which both have a row (in blocks, see pairs.py) and per-symbol totals, so that the dates-by-symbols
    matrix is never built; pairs of symbols are what the result is.
    """
    df = rets.select("symbol", "timestamp", F.coalesce("ret", F.lit(0.0)).alias("x"))
    dates = df.agg(F.count_distinct("timestamp").cast("double").alias("n"))
    sums = df.groupBy("symbol").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    products = pairs_by_date(df, "x", same=True).groupBy("symbol", "other").agg(F.sum(F.col("x") * F.col("y")).alias("xy"))
    crossed = products.join(sums, "symbol").join(sums.select(F.col("symbol").alias("other"), F.col("s").alias("s_b"), F.col("q").alias("q_b")), "other").crossJoin(F.broadcast(dates))
    cov = F.col("n") * F.col("xy") - F.col("s") * F.col("s_b")
    var = (F.col("n") * F.col("q") - F.col("s") ** 2) * (F.col("n") * F.col("q_b") - F.col("s_b") ** 2)
    return crossed.select("symbol", "other", r(F.try_divide(cov, F.sqrt(F.when(var > 0, var)))).alias("correlation"))


def beta_alpha(rets: DataFrame, benchmark: DataFrame, rf: float = 0.02) -> DataFrame:
    """Beta, Jensen's alpha and R² against a benchmark (timestamp, market)."""
    both = rets.where("ret IS NOT NULL").join(benchmark.where("market IS NOT NULL"), "timestamp")
    beta = F.try_divide(F.covar_samp("ret", "market"), F.var_samp("market"))
    alpha = (F.avg("ret") * YEAR) - (rf + beta * (F.avg("market") * YEAR - rf))
    return both.groupBy("symbol").agg(F.count("*").alias("n"), r(beta).alias("beta"), r(alpha).alias("alpha"), r(F.pow(F.corr("ret", "market"), F.lit(2.0))).alias("r_squared"))


def rolling_metrics(rets: DataFrame, n: int = 20) -> DataFrame:
    """Volatility, summed return and Sharpe over n rows, from the n-th on."""
    w = last_rows(n)
    df = rets.withColumn("ret", F.coalesce("ret", F.lit(0.0))).withColumn("_n", F.count("ret").over(w))
    vol, mean = F.stddev_samp("ret").over(w) * F.sqrt(F.lit(YEAR)), F.avg("ret").over(w) * YEAR
    out = df.select("symbol", "timestamp", "_n", r(vol).alias("volatility"), r(F.sum("ret").over(w)).alias("return_sum"), r(F.try_divide(mean, vol)).alias("sharpe"))
    return out.where(F.col("_n") == n).drop("_n")


def drawdowns(rets: DataFrame) -> DataFrame:
    df = _curve(rets)
    down = F.col("drawdown") < 0
    before = F.coalesce(F.lag(down).over(by_symbol()), F.lit(False))
    return df.select("symbol", "timestamp", r("equity").alias("equity"), r("peak").alias("peak"), r("drawdown").alias("drawdown"), (down & ~before).alias("starts"), (~down & before).alias("ends"))


def portfolio_daily(rets: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """The weighted return of each date and its growth; weights: symbol, weight, made to add up to 1 (equal by default)."""
    weights = weights if weights is not None else rets.select("symbol").distinct().withColumn("weight", F.lit(1.0))
    total = weights.agg(F.sum("weight").alias("_total"))
    share = weights.crossJoin(F.broadcast(total)).select("symbol", F.try_divide("weight", "_total").alias("weight"))
    daily = rets.join(share, "symbol").groupBy("timestamp").agg(F.sum(F.coalesce("ret", F.lit(0.0)) * F.col("weight")).alias("ret"))
    return _curve(daily.withColumn("symbol", F.lit("portfolio")))


def portfolio(rets: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    return performance(portfolio_daily(rets, weights).select("symbol", "timestamp", "ret"))


def contributions(rets: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """What each symbol's weighted returns add up to."""
    weights = weights if weights is not None else rets.select("symbol").distinct().withColumn("weight", F.lit(1.0))
    total = weights.agg(F.sum("weight").alias("_total"))
    share = weights.crossJoin(F.broadcast(total)).select("symbol", F.try_divide("weight", "_total").alias("weight"))
    return rets.join(share, "symbol").groupBy("symbol").agg(r(F.sum(F.coalesce("ret", F.lit(0.0)) * F.col("weight"))).alias("contribution"))


def distribution(rets: DataFrame) -> DataFrame:
    ret, n = F.col("ret"), F.count("ret")
    out = rets.groupBy("symbol").agg(
        n.alias("n"), r(F.avg(ret)).alias("mean"), r(F.stddev_samp(ret)).alias("std"), r(bias_corrected_skew(ret, n), 4).alias("skew"), r(bias_corrected_kurtosis(ret, n), 4).alias("kurtosis"),
    )
    return _with_percentiles(out, rets, (1, 5, 50, 95, 99))


def volatility_report(rets: DataFrame) -> DataFrame:
    return performance(rets).select("symbol", "volatility", "max_drawdown", "var_95")


def risk_report(rets: DataFrame, benchmark: DataFrame) -> DataFrame:
    return performance(rets).select("symbol", "volatility", "max_drawdown", "sharpe", "var_95").join(beta_alpha(rets, benchmark).select("symbol", "beta", "alpha"), "symbol", "left")


def rolling_risk(rets: DataFrame, windows: Sequence[int] = (21, 63, 252), rf: float = 0.02) -> DataFrame:
    """Per window n (from max(5, n / 2) returns on): volatility, annualised compound return, its excess over rf, Sharpe, Sortino.

    And the equity, its high-water mark and the drawdown. Null and infinite returns and repeated timestamps go first;
    returns of -1 and less have no logarithm and go, too. The compound return of a wild series can be beyond any
    scale: log_return_n is its logarithm, ln(1 + return_n).
    """
    fine = "ret IS NOT NULL AND NOT isnan(ret) AND ret > -1 AND ret < double('infinity')"
    df = _curve(rets.where(fine).dropDuplicates(["symbol", "timestamp"]))
    df = df.withColumns({"_down": F.least("ret", F.lit(0.0)), "_log": F.log1p("ret")})
    made = {}
    for n in windows:  # each frame is summed up once: what is made of the sums follows in a projection of its own
        w = last_rows(n)
        sums = {"n": F.count("ret"), "log": F.sum("_log"), "vol": F.stddev_samp("ret"), "down": F.stddev_samp("_down")}
        df = df.withColumns({f"_{k}_{n}": value.over(w) for k, value in sums.items()})
        count, log, vol, down = (F.when(F.col(f"_n_{n}") >= max(5, n // 2), F.col(f"_{k}_{n}")) for k in sums)
        grown, vol, down = log * YEAR / count, vol * F.sqrt(F.lit(YEAR)), down * F.sqrt(F.lit(YEAR))
        excess = F.exp(grown) - 1 - rf
        made |= {
            f"vol_{n}": r(vol), f"log_return_{n}": r(grown, 4), f"return_{n}": r(F.exp(grown) - 1, 4), f"excess_{n}": r(excess, 4),
            f"sharpe_{n}": r(F.try_divide(excess, vol), 4), f"sortino_{n}": r(F.try_divide(excess, down), 4),
        }
    return df.select("symbol", "timestamp", r("equity").alias("equity"), r("peak").alias("high_water_mark"), r("drawdown").alias("drawdown"), *(c.alias(k) for k, c in made.items()))


def summary_risk(rets: DataFrame, rf: float = 0.02) -> DataFrame:
    """One row of risk measures for each symbol; growth counts from the first return's equity on.

    CVaR is the mean of returns up to the VaR, by a second pass.
    """
    df = _curve(rets.where("ret IS NOT NULL AND NOT isnan(ret) AND abs(ret) < double('infinity')"))
    bound = percentiles(df, ["symbol"], {"var": F.col("ret")}, [0.05]).withColumn("var", F.col("var")[0])
    ret, n = F.col("ret"), F.count("ret")
    gain, loss = F.sum(F.when(ret > 0, ret)), F.abs(F.sum(F.when(ret < 0, ret)))
    growth = F.try_divide(F.max_by("equity", "timestamp"), F.min_by("equity", "timestamp"))
    annual = F.pow(growth, YEAR / n) - 1
    spread = lambda c: F.stddev_samp(c) * F.sqrt(F.lit(YEAR))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return df.join(bound, "symbol").groupBy("symbol").agg(
        n.alias("n"), r(growth - 1).alias("total_return"), r(annual).alias("annual_return"), r(zero(spread(ret))).alias("volatility"),
        r(zero(F.try_divide(annual - rf, spread(ret)))).alias("sharpe"), r(zero(F.try_divide(annual - rf, spread(F.when(ret < 0, ret))))).alias("sortino"),
        r(F.min("drawdown")).alias("max_drawdown"), r(zero(F.try_divide(annual, F.abs(F.min("drawdown"))))).alias("calmar"),
        r(zero(bias_corrected_skew(ret, n)), 4).alias("skew"), r(zero(bias_corrected_kurtosis(ret, n)), 4).alias("kurtosis"),
        r(F.first("var")).alias("var_95"), r(zero(F.avg(F.when(ret <= F.col("var"), ret)))).alias("cvar_95"), r(F.max(ret)).alias("best"), r(F.min(ret)).alias("worst"), r(F.avg(ret)).alias("mean"),
        r(zero(F.avg(F.when(ret > 0, ret)))).alias("avg_gain"), r(zero(F.avg(F.when(ret < 0, ret)))).alias("avg_loss"), r(F.avg((ret > 0).cast("double"))).alias("hit_ratio"),
        r(F.try_divide(gain, loss)).alias("profit_factor"), r(n / YEAR).alias("years"),
    )


def _clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def vol_target(metrics: DataFrame, target: float = 0.15, alpha: float = 0.1, low: float = 0.1, high: float = 3.0) -> DataFrame:
    """target / volatility (target where that is bad), smoothed and clipped; metrics: symbol, timestamp, volatility."""
    raw = F.when(F.col("volatility") > 0, target / F.col("volatility")).otherwise(target)
    smooth = ewm(metrics.select("symbol", "timestamp", raw.alias("raw")), {"scaling": ("raw", alpha)})
    return smooth.withColumn("scaling", _clip(F.col("scaling"), low, high)).drop("raw")


def sharpe_vol(metrics: DataFrame, target_sharpe: float = 1.0, target_vol: float = 0.15, alpha: float = 0.1, low: float = 0.1, high: float = 3.0) -> DataFrame:
    raw = _clip(F.coalesce(F.col("sharpe") / target_sharpe, F.lit(0.0)), 0.0, 2.0) * _clip(F.coalesce(F.try_divide(F.lit(target_vol), F.col("volatility")), F.lit(1.0)), 0.0, 2.0)
    smooth = ewm(metrics.select("symbol", "timestamp", raw.alias("raw")), {"scaling": ("raw", alpha)})
    return smooth.withColumn("scaling", _clip(F.col("scaling"), low, high)).drop("raw")


def drawdown_scale(curve: DataFrame, limit: float = 0.2) -> DataFrame:
    return curve.withColumn("scaling", r(_clip(1 - F.abs("drawdown") / limit * 0.5, 0.1, 1.0)))


def regime(metrics: DataFrame, n: int = 63) -> DataFrame:
    """Low, normal or high volatility against its mean over n rows, and the factor for each."""
    ratio = F.try_divide(F.col("volatility"), F.avg("volatility").over(last_rows(n)))
    label = F.when(ratio < 0.75, "low").when(ratio > 1.25, "high").otherwise("normal")
    return metrics.withColumn("regime", label).withColumn("factor", F.when(F.col("regime") == "low", 1.25).when(F.col("regime") == "high", 0.75).otherwise(1.0))


def combine(scalings: DataFrame, weights: dict[str, float], low: float = 0.1, high: float = 3.0) -> DataFrame:
    total = sum(weights.values())
    value = F.lit(0.0)
    for c, weight in weights.items():
        value = value + F.coalesce(F.col(c), F.lit(1.0)) * (weight / total)
    return scalings.withColumn("combined", r(_clip(value, low, high)))


def exposure(positions: DataFrame, specs: DataFrame, equity: float = 1_000_000.0, limit_pct: float = 0.25, max_size: float | None = None) -> DataFrame:
    """Notional and margin of each position and their shares of equity in per cent, and the quantity within the limits.

    positions: symbol, quantity, price; specs: symbol, multiplier, margin (of one contract). The limits are the
    contracts whose margin is limit_pct of equity (none without a margin) and max_size. A position without specs has null measures.
    """
    notional = F.abs(F.col("quantity") * F.col("price") * F.col("multiplier"))
    margin = F.abs(F.col("quantity") * F.col("margin"))
    by_equity = F.when(F.col("margin") > 0, equity * limit_pct / F.col("margin"))
    limit = F.least(by_equity, F.lit(max_size).cast("double"))  # least() skips nulls
    held = F.when(limit.isNull(), F.col("quantity")).otherwise(F.least(F.greatest(F.col("quantity").cast("double"), -limit), limit))
    made = {"notional": r(notional), "exposure_pct": r(notional * 100.0 / equity), "margin_used": r(margin), "margin_pct": r(margin * 100.0 / equity), "limited_quantity": r(held)}
    return positions.join(specs.select("symbol", "multiplier", "margin"), "symbol", "left").withColumns(made).drop("multiplier", "margin")


def term_structure(wide: DataFrame) -> DataFrame:
    """Front less index, second less front, and the premium; wide: date, index_value, first, second."""
    return wide.dropna().select(
        "date", r(F.col("first") - F.col("index_value")).alias("front_spread"), r(F.col("second") - F.col("first")).alias("next_spread"), r(F.try_divide((F.col("first") - F.col("index_value")) * 100.0, F.col("index_value"))).alias("premium_pct")
    )


def term_structure_stats(wide: DataFrame) -> DataFrame:
    s = term_structure(wide)
    rows = F.array(*(F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in ("front_spread", "next_spread", "premium_pct")))
    return s.select(F.inline(rows)).groupBy("measure").agg(F.count("*").alias("n"), r(F.avg("value")).alias("mean"), r(F.stddev_samp("value")).alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))


def trade_costs(trades: DataFrame, specs: DataFrame, rate: float = 0.0, least: float = 0.85, slippage: float = 0.0001) -> DataFrame:
    """Result and costs of trades (symbol, entry, exit, quantity) by the multiplier of their contract (specs: symbol, multiplier).

    Each leg costs the rate of its price a contract, `least` a contract at least, and slippage as a share of its value.
    """
    q, multiplier = F.abs("quantity"), F.col("multiplier")
    leg = lambda price: F.greatest(q * rate * F.col(price), q * least) + q * F.col(price) * multiplier * slippage
    made = {"pnl": r(F.col("quantity") * (F.col("exit") - F.col("entry")) * multiplier), "costs": r(leg("entry") + leg("exit"))}
    return trades.join(specs.select("symbol", "multiplier"), "symbol", "left").withColumns(made).drop("multiplier")
