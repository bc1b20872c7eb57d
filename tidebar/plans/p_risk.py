"""Queries: returns, performance and risk."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebar.operators import risk as m
from tidebar.plans.p_indicators import smoothed
from tidebar.plans.register import query
from tidebar.sources.adapters import Tables

BY = "OVER (PARTITION BY symbol ORDER BY timestamp)"
C = {
    "rets": f"SELECT symbol, timestamp, close, close / lag(close) {BY} - 1 AS ret FROM bars",
    "curve": "SELECT *, equity / peak - 1 AS drawdown FROM (SELECT *, max(equity) OVER (PARTITION BY symbol ORDER BY timestamp) AS peak FROM (SELECT symbol, timestamp, coalesce(ret, 0) AS ret, exp(sum(ln(1 + coalesce(ret, 0))) OVER (PARTITION BY symbol ORDER BY timestamp)) AS equity FROM rets))",
    "market": "SELECT timestamp, avg(ret) AS market FROM rets GROUP BY timestamp",
    "vols": "SELECT symbol, timestamp, stddev_samp(coalesce(ret, 0)) OVER (PARTITION BY symbol ORDER BY timestamp ROWS 19 PRECEDING) * sqrt(252.0) AS volatility FROM rets",
    "pcurve": "SELECT *, equity / peak - 1 AS drawdown FROM (SELECT *, max(equity) OVER (ORDER BY timestamp) AS peak FROM (SELECT 'portfolio' AS symbol, timestamp, ret, exp(sum(ln(1 + ret)) OVER (ORDER BY timestamp)) AS equity FROM (SELECT timestamp, sum(coalesce(ret, 0) / (SELECT count(DISTINCT symbol) FROM rets)) AS ret FROM rets GROUP BY timestamp)))",
}


def rets(t: Tables):
    return m.returns(t.bars).select("symbol", "timestamp", "ret")


def levered(t: Tables):
    return rets(t).withColumn("ret", F.col("ret") * 0.0001)


def market(t: Tables):
    return rets(t).groupBy("timestamp").agg(F.avg("ret").alias("market"))


@query("returns", f"SELECT symbol, timestamp, round(close / lag(close) {BY} - 1, 6) AS ret, round(ln(close / lag(close) {BY}), 6) AS log_return, round(close / first_value(close) {BY} - 1, 6) AS cumulative FROM bars")
def _(t: Tables):
    out = m.returns(t.bars)
    return out.select("symbol", "timestamp", *(F.round(c, 6).alias(c) for c in ("ret", "log_return", "cumulative")))


@query("returns_monthly", f"SELECT symbol, timestamp, round(close / lag(close, 21) {BY} - 1, 6) AS ret FROM bars")
def _(t: Tables):
    return m.returns(t.bars, "monthly").select("symbol", "timestamp", F.round("ret", 6).alias("ret"))


_PERF = """round(arg_max(equity, timestamp) - 1, 6) AS total_return, round(pow(arg_max(equity, timestamp), 1 / greatest(date_diff('day', min(timestamp), max(timestamp)) / 365.0, 0.01)) - 1, 6) AS cagr, round(stddev_samp(ret) * sqrt(252.0), 6) AS volatility, round(min(drawdown), 6) AS max_drawdown,
    round(avg(ret) * 252.0 / nullif(stddev_samp(ret) * sqrt(252.0), 0), 6) AS sharpe, round(avg(ret) * 252.0 / nullif(stddev_samp(ret) FILTER (ret < 0) * sqrt(252.0), 0), 6) AS sortino, round(quantile_cont(ret, 0.05), 6) AS var_95, round(skewness(ret), 4) AS skew, round(kurtosis(ret), 4) AS kurtosis, round(avg((ret > 0)::INT), 6) AS positive_share,
    round(avg(ret), 6) AS mean, round(median(ret), 6) AS median, round(quantile_cont(ret, 0.1), 6) AS p10, round(quantile_cont(ret, 0.25), 6) AS p25, round(quantile_cont(ret, 0.75), 6) AS p75, round(quantile_cont(ret, 0.9), 6) AS p90"""


@query("performance_metrics", f"SELECT symbol, count(*) AS n, {_PERF} FROM curve GROUP BY symbol HAVING count(*) >= 2", C)
def _(t: Tables):
    return m.performance(rets(t))


@query("correlation_matrix", "WITH s AS (SELECT DISTINCT symbol FROM rets), d AS (SELECT DISTINCT timestamp FROM rets), w AS (SELECT s.symbol, d.timestamp, coalesce(r.ret, 0) AS ret FROM s CROSS JOIN d LEFT JOIN rets r ON r.symbol = s.symbol AND r.timestamp = d.timestamp) SELECT a.symbol, b.symbol AS other, round(corr(a.ret, b.ret), 6) AS correlation FROM w a JOIN w b ON a.timestamp = b.timestamp AND a.symbol <= b.symbol WHERE EXISTS (SELECT 1 FROM rets x JOIN rets y ON x.timestamp = y.timestamp WHERE x.symbol = a.symbol AND y.symbol = b.symbol) GROUP BY 1, 2", C)
def _(t: Tables):
    return m.correlation(rets(t))


_BETA = "count(*) AS n, round(covar_samp(ret, market) / nullif(var_samp(market), 0), 6) AS beta, round(avg(ret) * 252.0 - (0.02 + covar_samp(ret, market) / nullif(var_samp(market), 0) * (avg(market) * 252.0 - 0.02)), 6) AS alpha, round(pow(corr(ret, market), 2), 6) AS r_squared FROM rets r JOIN market USING (timestamp) WHERE ret IS NOT NULL AND market IS NOT NULL GROUP BY symbol"


@query("beta_alpha", f"SELECT symbol, {_BETA}", C)
def _(t: Tables):
    return m.beta_alpha(rets(t), market(t))


@query("rolling_metrics", """SELECT symbol, timestamp, round(v, 6) AS volatility, round(s, 6) AS return_sum, round(a / nullif(v, 0), 6) AS sharpe FROM (SELECT symbol, timestamp, count(*) OVER w AS n, stddev_samp(coalesce(ret, 0)) OVER w * sqrt(252.0) AS v, sum(coalesce(ret, 0)) OVER w AS s, avg(coalesce(ret, 0)) OVER w * 252.0 AS a FROM rets
    WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS 19 PRECEDING)) WHERE n = 20""", C)
def _(t: Tables):
    return m.rolling_metrics(rets(t))


@query("drawdowns", """SELECT symbol, timestamp, round(equity, 6) AS equity, round(peak, 6) AS peak, round(drawdown, 6) AS drawdown, d AND NOT coalesce(lag(d) OVER w, false) AS starts, NOT d AND coalesce(lag(d) OVER w, false) AS ends
    FROM (SELECT *, drawdown < 0 AS d FROM curve) WINDOW w AS (PARTITION BY symbol ORDER BY timestamp)""", C)
def _(t: Tables):
    return m.drawdowns(rets(t))


@query("portfolio", f"SELECT symbol, count(*) AS n, {_PERF} FROM pcurve GROUP BY symbol", C)
def _(t: Tables):
    return m.portfolio(rets(t))


@query("portfolio_contributions", "SELECT symbol, round(sum(coalesce(ret, 0) / (SELECT count(DISTINCT symbol) FROM rets)), 6) AS contribution FROM rets GROUP BY symbol", C)
def _(t: Tables):
    return m.contributions(rets(t))


@query("return_distribution", f"SELECT symbol, count(ret) AS n, round(avg(ret), 6) AS mean, round(stddev_samp(ret), 6) AS std, round(skewness(ret), 4) AS skew, round(kurtosis(ret), 4) AS kurtosis, {', '.join(f'round(quantile_cont(ret, {p / 100}), 6) AS p{p}' for p in (1, 5, 50, 95, 99))} FROM rets GROUP BY symbol", C)
def _(t: Tables):
    return m.distribution(rets(t))


@query("volatility_report", "SELECT symbol, round(stddev_samp(ret) * sqrt(252.0), 6) AS volatility, round(min(drawdown), 6) AS max_drawdown, round(quantile_cont(ret, 0.05), 6) AS var_95 FROM curve GROUP BY symbol HAVING count(*) >= 2", C)
def _(t: Tables):
    return m.volatility_report(rets(t))


@query("risk_report", f"WITH b AS (SELECT symbol, {_BETA}) SELECT c.*, b.beta, b.alpha FROM (SELECT symbol, round(stddev_samp(ret) * sqrt(252.0), 6) AS volatility, round(min(drawdown), 6) AS max_drawdown, round(avg(ret) * 252.0 / nullif(stddev_samp(ret) * sqrt(252.0), 0), 6) AS sharpe, round(quantile_cont(ret, 0.05), 6) AS var_95 FROM curve GROUP BY symbol HAVING count(*) >= 2) c LEFT JOIN b ON b.symbol = c.symbol", C)
def _(t: Tables):
    return m.risk_report(rets(t), market(t))


def _rolled(n: int) -> str:
    w = f"(PARTITION BY symbol ORDER BY timestamp ROWS {n - 1} PRECEDING)"
    return f"count(*) OVER {w} AS n{n}, stddev_samp(ret) OVER {w} * sqrt(252.0) AS v{n}, sum(ln(1 + ret)) OVER {w} * 252.0 / count(*) OVER {w} AS a{n}, stddev_samp(least(ret, 0.0)) OVER {w} * sqrt(252.0) AS d{n}"


def _measures(n: int) -> str:
    annual = f"(CASE WHEN a{n} < 700 THEN exp(a{n}) ELSE 'infinity'::DOUBLE END - 1)"
    of = {"vol": (f"v{n}", 6), "log_return": (f"a{n}", 4), "return": (annual, 4), "excess": (f"{annual} - 0.02", 4), "sharpe": (f"({annual} - 0.02) / nullif(v{n}, 0)", 4), "sortino": (f"({annual} - 0.02) / nullif(d{n}, 0)", 4)}
    return ", ".join(f"CASE WHEN n{n} >= {max(5, n // 2)} THEN round({x}, {digits}) END AS {name}_{n}" for name, (x, digits) in of.items())


WINDOWS = (21, 63, 252)
_ROLL = {
    **C,
    # a position of a ten-thousandth of the capital: whole daily returns of this table compound beyond what doubles hold alike
    "rcurve": "SELECT *, max(equity) OVER (PARTITION BY symbol ORDER BY timestamp) AS peak FROM (SELECT symbol, timestamp, ret, exp(sum(ln(1 + ret)) OVER (PARTITION BY symbol ORDER BY timestamp)) AS equity FROM (SELECT symbol, timestamp, ret * 0.0001 AS ret FROM rets WHERE ret IS NOT NULL))",
    "rolled": f"SELECT *, {', '.join(map(_rolled, WINDOWS))} FROM rcurve",
}


@query("rolling_risk", f"SELECT symbol, timestamp, round(equity, 6) AS equity, round(peak, 6) AS high_water_mark, round(equity / peak - 1, 6) AS drawdown, {', '.join(map(_measures, WINDOWS))} FROM rolled", _ROLL)
def _(t: Tables):
    return m.rolling_risk(levered(t), WINDOWS)


@query("summary_risk", """WITH v AS (SELECT symbol, quantile_cont(ret, 0.05) AS v FROM rcurve GROUP BY symbol), g AS (SELECT c.symbol, count(*) AS n, arg_max(equity, timestamp) / arg_min(equity, timestamp) AS growth, stddev_samp(ret) * sqrt(252.0) AS vol, stddev_samp(ret) FILTER (ret < 0) * sqrt(252.0) AS down, min(equity / peak - 1) AS dd, skewness(ret) AS skew, kurtosis(ret) AS kurtosis,
    any_value(v) AS v, avg(ret) FILTER (ret <= v) AS cvar, max(ret) AS best, min(ret) AS worst, avg(ret) AS mean, avg(ret) FILTER (ret > 0) AS gain, avg(ret) FILTER (ret < 0) AS loss, avg((ret > 0)::INT) AS hits, sum(ret) FILTER (ret > 0) / nullif(abs(sum(ret) FILTER (ret < 0)), 0) AS factor FROM rcurve c JOIN v ON v.symbol = c.symbol GROUP BY c.symbol)
    SELECT symbol, n, round(growth - 1, 6) AS total_return, round(annual, 6) AS annual_return, round(coalesce(vol, 0), 6) AS volatility, round(coalesce((annual - 0.02) / nullif(vol, 0), 0), 6) AS sharpe, round(coalesce((annual - 0.02) / nullif(down, 0), 0), 6) AS sortino, round(dd, 6) AS max_drawdown, round(coalesce(annual / nullif(abs(dd), 0), 0), 6) AS calmar,
    round(coalesce(skew, 0), 4) AS skew, round(coalesce(kurtosis, 0), 4) AS kurtosis, round(v, 6) AS var_95, round(coalesce(cvar, 0), 6) AS cvar_95, round(best, 6) AS best, round(worst, 6) AS worst, round(mean, 6) AS mean, round(coalesce(gain, 0), 6) AS avg_gain, round(coalesce(loss, 0), 6) AS avg_loss, round(hits, 6) AS hit_ratio, round(factor, 6) AS profit_factor, round(n / 252.0, 6) AS years FROM (SELECT *, pow(growth, 252.0 / n) - 1 AS annual FROM g)""", _ROLL)
def _(t: Tables):
    return m.summary_risk(levered(t))


def _metrics(t: Tables):
    return m.rolling_metrics(rets(t)).select("symbol", "timestamp", "volatility", "sharpe")


_METRICS = """SELECT symbol, timestamp, round(v, 6) AS volatility, round(a / nullif(v, 0), 6) AS sharpe FROM (SELECT symbol, timestamp, count(*) OVER w AS n, stddev_samp(coalesce(ret, 0)) OVER w * sqrt(252.0) AS v, avg(coalesce(ret, 0)) OVER w * 252.0 AS a FROM rets WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS 19 PRECEDING)) WHERE n = 20"""
_SCALED = {
    **C,
    "metrics": " ".join(_METRICS.split()),
    "vol_raw": "SELECT symbol, timestamp, CASE WHEN volatility > 0 THEN 0.15 / volatility ELSE 0.15 END AS raw FROM metrics",
    "vol_smooth": smoothed("vol_raw", "raw", 0.1),
    "sharpe_raw": "SELECT symbol, timestamp, least(greatest(coalesce(sharpe, 0), 0.0), 2.0) * least(greatest(coalesce(0.15 / nullif(volatility, 0), 1.0), 0.0), 2.0) AS raw FROM metrics",
    "sharpe_smooth": smoothed("sharpe_raw", "raw", 0.1),
}


@query("vol_target_scaling", "SELECT symbol, timestamp, round(least(greatest(e, 0.1), 3.0), 6) AS scaling FROM vol_smooth", _SCALED)
def _(t: Tables):
    return m.vol_target(_metrics(t)).withColumn("scaling", F.round("scaling", 6))


@query("sharpe_vol_scaling", "SELECT symbol, timestamp, round(least(greatest(e, 0.1), 3.0), 6) AS scaling FROM sharpe_smooth", _SCALED)
def _(t: Tables):
    return m.sharpe_vol(_metrics(t)).withColumn("scaling", F.round("scaling", 6))


@query("drawdown_scaling", "SELECT symbol, timestamp, round(least(greatest(1 - abs(round(drawdown, 6)) / 0.2 * 0.5, 0.1), 1.0), 6) AS scaling FROM curve", C)
def _(t: Tables):
    return m.drawdown_scale(m.drawdowns(rets(t))).select("symbol", "timestamp", "scaling")


_REGIME = "SELECT symbol, timestamp, CASE WHEN q < 0.75 THEN 'low' WHEN q > 1.25 THEN 'high' ELSE 'normal' END AS regime, CASE WHEN q < 0.75 THEN 1.25 WHEN q > 1.25 THEN 0.75 ELSE 1.0 END::DOUBLE AS factor FROM (SELECT symbol, timestamp, volatility / nullif(avg(volatility) OVER (PARTITION BY symbol ORDER BY timestamp ROWS 62 PRECEDING), 0) AS q FROM vols)"


def _vols(t: Tables):
    from tidebar.functions.scalars import last_rows

    return rets(t).withColumn("volatility", F.stddev_samp(F.coalesce("ret", F.lit(0.0))).over(last_rows(20)) * F.sqrt(F.lit(252.0))).select("symbol", "timestamp", "volatility")


@query("regime", _REGIME, C)
def _(t: Tables):
    return m.regime(_vols(t)).select("symbol", "timestamp", "regime", F.col("factor").cast("double").alias("factor"))


@query("combined_scaling", f"WITH a AS ({_REGIME}), b AS (SELECT symbol, timestamp, round(least(greatest(1 - abs(round(drawdown, 6)) / 0.2 * 0.5, 0.1), 1.0), 6) AS scaling FROM curve) SELECT a.symbol, a.timestamp, round(least(greatest(factor * 0.6 + scaling * 0.4, 0.1), 3.0), 6) AS combined FROM a JOIN b ON a.symbol = b.symbol AND a.timestamp = b.timestamp", C)
def _(t: Tables):
    both = m.regime(_vols(t)).join(m.drawdown_scale(m.drawdowns(rets(t))).select("symbol", "timestamp", "scaling"), ["symbol", "timestamp"])
    return m.combine(both, {"factor": 0.6, "scaling": 0.4}).select("symbol", "timestamp", "combined")


@query("exposure", """SELECT account_id, symbol, timestamp, round(abs(quantity * price * multiplier), 6) AS notional, round(abs(quantity * price * multiplier) * 100.0 / 1e6, 6) AS exposure_pct, round(abs(quantity * margin), 6) AS margin_used, round(abs(quantity * margin) * 100.0 / 1e6, 6) AS margin_pct,
    round(least(greatest(quantity::DOUBLE, -cap), cap), 6) AS limited_quantity FROM (SELECT p.*, market_value / nullif(abs(quantity), 0) AS price, margin, multiplier, least(1e6 * 0.05 / margin, 40.0)::DOUBLE AS cap FROM positions p LEFT JOIN specs s ON s.symbol = p.symbol)""")
def _(t: Tables):
    priced = t.positions.select("account_id", "symbol", "timestamp", "quantity", F.try_divide(F.col("market_value"), F.abs("quantity")).alias("price"))
    return m.exposure(priced, t.specs, limit_pct=0.05, max_size=40.0).drop("quantity", "price")


_WIDE = "SELECT timestamp::DATE AS date, max(close) FILTER (symbol = 'Brand#1') AS i, max(close) FILTER (symbol = 'Brand#2') AS a, max(close) FILTER (symbol = 'Brand#3') AS b FROM bars WHERE symbol IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY 1"
_TERM = f"SELECT date, round(a - i, 6) AS front_spread, round(b - a, 6) AS next_spread, round((a - i) * 100.0 / nullif(i, 0), 6) AS premium_pct FROM ({_WIDE}) WHERE i IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL"


def _wide(t: Tables):
    from tidebar.operators.joins import wide_series

    return wide_series(t.bars, ["Brand#1", "Brand#2", "Brand#3"]).toDF("date", "index_value", "first", "second")


@query("term_structure_spreads", _TERM)
def _(t: Tables):
    return m.term_structure(_wide(t))


@query("term_structure_stats", " UNION ALL ".join(f"SELECT '{c}' AS measure, count(*) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min, max({c}) AS max FROM ({_TERM}) HAVING count(*) > 0" for c in ("front_spread", "next_spread", "premium_pct")))
def _(t: Tables):
    return m.term_structure_stats(_wide(t))


@query("trade_costs", """SELECT n AS id, symbol, timestamp, round(quantity * (exit - entry) * multiplier, 6) AS pnl, round(greatest(q * 0.001 * entry, q * 0.85) + q * entry * multiplier * 0.0001 + (greatest(q * 0.001 * exit, q * 0.85) + q * exit * multiplier * 0.0001), 6) AS costs
    FROM (SELECT b.symbol, timestamp, dayofyear(timestamp) AS n, open AS entry, close AS exit, volume % 7 - 3 AS quantity, abs(volume % 7 - 3) AS q, multiplier FROM bars b LEFT JOIN specs s ON s.symbol = b.symbol)""")
def _(t: Tables):
    trades = t.bars.select("symbol", "timestamp", F.dayofyear("timestamp").cast("long").alias("id"), F.col("open").alias("entry"), F.col("close").alias("exit"), (F.col("volume") % 7 - 3).alias("quantity"))
    return m.trade_costs(trades, t.specs, rate=0.001).select("id", "symbol", "timestamp", "pnl", "costs")
