"""Queries: technical indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebar.operators import indicators as i
from tidebar.plans.register import query
from tidebar.sources.adapters import Tables

W = "PARTITION BY symbol ORDER BY timestamp ROWS {} PRECEDING"
BY = "OVER (PARTITION BY symbol ORDER BY timestamp)"


def smoothed(source: str, value: str, alpha: float, order: str = "timestamp", keep: str = "timestamp") -> str:
    """SQL for the recursion e = e + alpha (x - e), step by step over a list of each symbol: (symbol, keep, value, e)."""
    step = f"lambda acc, v: list_append(acc, coalesce(acc[-1] + {alpha!r} * (v[1] - acc[-1]), acc[-1], v[1]))"
    return f"""SELECT symbol, unnest(k) AS {keep}, unnest(x) AS {value}, unnest(e) AS e FROM (SELECT symbol, list({keep} ORDER BY {order}) AS k, list({value} ORDER BY {order}) AS x, list_reduce(list([{value}::DOUBLE] ORDER BY {order}), {step}) AS e FROM {source} GROUP BY symbol)"""


_EMA = {"ema_rows": smoothed("bars", "close", 2 / 21)}
_MACD = {
    "macd_fast": smoothed("bars", "close", 2 / 13), "macd_slow": smoothed("bars", "close", 2 / 27),
    "macd_line": "SELECT f.symbol, f.timestamp, f.e - s.e AS m FROM macd_fast f JOIN macd_slow s ON f.symbol = s.symbol AND f.timestamp = s.timestamp",
    "macd_rows": smoothed("macd_line", "m", 2 / 10),
}


_SMA = f"SELECT symbol, timestamp, CASE WHEN count(close) OVER w = 20 THEN round(avg(close) OVER w, 6) END AS sma_20 FROM bars WINDOW w AS ({W.format(19)})"


@query("sma", _SMA)
def _(t: Tables):
    return i.rounded(i.sma(t.bars, 20), "sma_20")


@query("ema", "SELECT symbol, timestamp, round(e, 6) AS ema_20 FROM ema_rows", _EMA)
def _(t: Tables):
    return i.rounded(i.ema(t.bars, 20), "ema_20")


_RSI = f"""SELECT symbol, timestamp, round(CASE WHEN count(m) OVER w = 14 THEN CASE WHEN avg(greatest(-m, 0)) OVER w = 0 THEN CASE WHEN avg(greatest(m, 0)) OVER w > 0 THEN 100.0 END ELSE 100 - 100 / (1 + avg(greatest(m, 0)) OVER w / avg(greatest(-m, 0)) OVER w) END END, 6) AS rsi_14
    FROM (SELECT *, close - lag(close) {BY} AS m FROM bars) WINDOW w AS ({W.format(13)})"""


@query("rsi", _RSI)
def _(t: Tables):
    return i.rounded(i.rsi(t.bars), "rsi_14")


@query("macd", "SELECT symbol, timestamp, round(m, 6) AS macd, round(e, 6) AS macd_signal, round(m - e, 6) AS macd_histogram FROM macd_rows", _MACD)
def _(t: Tables):
    return i.rounded(i.macd(t.bars.select("symbol", "timestamp", "close")), "macd", "macd_signal", "macd_histogram")


_BOLLINGER = f"""SELECT symbol, timestamp, round(m, 6) AS bb_middle, round(m + 2 * s, 6) AS bb_upper, round(m - 2 * s, 6) AS bb_lower FROM (SELECT symbol, timestamp, CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END AS m,
    CASE WHEN count(close) OVER w = 20 THEN stddev_samp(close) OVER w END AS s FROM bars WINDOW w AS ({W.format(19)}))"""


@query("bollinger", _BOLLINGER)
def _(t: Tables):
    return i.rounded(i.bollinger(t.bars), "bb_middle", "bb_upper", "bb_lower")


_ATR = f"""SELECT symbol, timestamp, CASE WHEN count(r) OVER w = 14 THEN round(avg(r) OVER w, 6) END AS atr_14 FROM (SELECT *, greatest(high - low, abs(high - p), abs(low - p)) AS r FROM (SELECT *, lag(close) {BY} AS p FROM bars)) WINDOW w AS ({W.format(13)})"""


@query("atr", _ATR)
def _(t: Tables):
    return i.rounded(i.atr(t.bars), "atr_14")


_STOCHASTIC = f"""WITH a AS (SELECT symbol, timestamp, CASE WHEN count(close) OVER w = 14 THEN 100.0 * (close - min(low) OVER w) / nullif(max(high) OVER w - min(low) OVER w, 0) END AS raw FROM bars WINDOW w AS ({W.format(13)})),
    b AS (SELECT symbol, timestamp, CASE WHEN count(raw) OVER w = 3 THEN avg(raw) OVER w END AS k FROM a WINDOW w AS ({W.format(2)}))
    SELECT symbol, timestamp, round(k, 6) AS stoch_k, round(CASE WHEN count(k) OVER w = 3 THEN avg(k) OVER w END, 6) AS stoch_d FROM b WINDOW w AS ({W.format(2)})"""


@query("stochastic", _STOCHASTIC)
def _(t: Tables):
    return i.rounded(i.stochastic(t.bars), "stoch_k", "stoch_d")


@query("volume_sma", f"SELECT symbol, timestamp, CASE WHEN count(volume) OVER w = 20 THEN round(avg(volume) OVER w, 6) END AS sma_20 FROM bars WINDOW w AS ({W.format(19)})")
def _(t: Tables):
    return i.rounded(i.sma(t.bars, 20, "volume"), "sma_20")


def _long() -> str:
    """All indicators below one another, with their parameters as JSON."""
    flat = lambda sql: " ".join(sql.split())
    tables = {
        "sma": flat(_SMA), "ema": "SELECT symbol, timestamp, round(e, 6) AS ema_20 FROM ema_rows", "rsi": flat(_RSI),
        "macd": "SELECT symbol, timestamp, round(m, 6) AS macd, round(e, 6) AS macd_signal, round(m - e, 6) AS macd_histogram FROM macd_rows",
        "bollinger": flat(_BOLLINGER), "atr": flat(_ATR), "stochastic": flat(_STOCHASTIC),
    }
    parts = []
    for name, (_, columns, parameters) in i.INDICATORS.items():
        json = "{" + ",".join(f'"{k}":{float(v)}' for k, v in parameters.items()) + "}"
        parts += [f"SELECT timestamp, symbol, '{c}' AS indicator_name, {c} AS value, '{json}' AS parameters FROM ({tables[name]}) WHERE {c} IS NOT NULL" for c in columns]
    return " UNION ALL ".join(parts)


@query("indicators_long", _long(), {**_EMA, **_MACD})
def _(t: Tables):
    return i.indicators_long(t.bars.select("symbol", "timestamp", "high", "low", "close")).withColumn("value", F.round("value", 6))


_LONG = "SELECT symbol, timestamp, 'sma_20' AS indicator_name, CASE WHEN count(close) OVER w = 20 THEN round(avg(close) OVER w, 6) END AS value FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS 19 PRECEDING)"


@query("save_indicators", f"WITH n AS (SELECT * FROM ({_LONG}) WHERE value IS NOT NULL) SELECT symbol, timestamp, indicator_name, CASE WHEN dayofyear(timestamp) % 2 = 0 THEN -1.0 ELSE value END AS value FROM n")
def _(t: Tables):
    from tidebar.sources.tables import insert_new

    new = i.indicators_long(t.bars.select("symbol", "timestamp", "close"), ["sma"]).select("symbol", "timestamp", "indicator_name", F.round("value", 6).alias("value"))
    existing = new.where(F.dayofyear("timestamp") % 2 == 0).withColumn("value", F.lit(-1.0))
    return insert_new(existing, new, ["symbol", "timestamp", "indicator_name"])


_HOURLY = "SELECT symbol, date_trunc('hour', timestamp) AS timestamp, arg_min(open, {'a': timestamp, 'b': id}) AS open, arg_max(close, {'a': timestamp, 'b': id}) AS close FROM ticks GROUP BY symbol, date_trunc('hour', timestamp)"
BANDS = {
    "hourly": _HOURLY,
    "band_days": "SELECT symbol, date, day_open, lag(day_close) OVER (PARTITION BY symbol ORDER BY date) AS prev_close FROM (SELECT symbol, timestamp::DATE AS date, arg_min(open, timestamp) AS day_open, arg_max(close, timestamp) AS day_close FROM hourly GROUP BY 1, 2)",
    "band_moves": "SELECT h.symbol, h.timestamp, h.close, d.day_open, d.prev_close, abs(h.close / nullif(d.day_open, 0) - 1) AS move FROM hourly h JOIN band_days d ON d.symbol = h.symbol AND d.date = h.timestamp::DATE",
    "band_avg": "SELECT *, CASE WHEN count(move) OVER w >= 5 THEN avg(move) OVER w END AS a FROM band_moves WINDOW w AS (PARTITION BY symbol, hour(timestamp) ORDER BY timestamp ROWS 13 PRECEDING)",
    "band_fill": "SELECT *, last_value(a IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS avg_move FROM band_avg",
    "bands": "SELECT symbol, timestamp, close, greatest(greatest(day_open, prev_close) * (1 + avg_move), least(day_open, prev_close) * (1 - avg_move)) AS upper, least(greatest(day_open, prev_close) * (1 + avg_move), least(day_open, prev_close) * (1 - avg_move)) AS lower FROM band_fill",
}


def _bands(t: Tables):
    from tidebar.operators.bars import resample

    return i.noise_bands(resample(t.ticks, "hour", tie="id"))


@query("noise_bands", "SELECT symbol, timestamp, round(upper, 6) AS upper, round(lower, 6) AS lower FROM bands", BANDS)
def _(t: Tables):
    return i.rounded(_bands(t), "upper", "lower")


_SIGNAL = "CASE WHEN strftime(timestamp, '%H:%M') BETWEEN '09:30' AND '15:30' AND close > upper THEN 1 WHEN strftime(timestamp, '%H:%M') BETWEEN '09:30' AND '15:30' AND close < lower THEN -1 ELSE 0 END"


@query("breakout_signals", f"SELECT symbol, {_SIGNAL} AS signal, count(*) AS n FROM bands GROUP BY 1, 2", BANDS)
def _(t: Tables):
    return i.signal_counts(i.breakout_signals(_bands(t)))


@query("breakout_stops", f"""SELECT symbol, timestamp, -1 * {_SIGNAL} AS signal, round(CASE WHEN strftime(timestamp, '%H:%M') BETWEEN '09:30' AND '16:00' THEN CASE WHEN strftime(timestamp, '%H:%M') < '16:00' THEN v ELSE close END END, 6) AS stop FROM (SELECT *, sum(CASE WHEN strftime(timestamp, '%H:%M') BETWEEN '09:30' AND '15:59' THEN close * volume END) OVER d
    / nullif(sum(CASE WHEN strftime(timestamp, '%H:%M') BETWEEN '09:30' AND '15:59' THEN volume END) OVER d, 0) AS v FROM bands JOIN (SELECT symbol AS s, date_trunc('hour', timestamp) AS h, count(*) AS volume FROM ticks GROUP BY 1, 2) ON s = symbol AND h = timestamp WINDOW d AS (PARTITION BY symbol, CAST(timestamp AS DATE) ORDER BY timestamp ROWS UNBOUNDED PRECEDING))""", BANDS)
def _(t: Tables):
    from tidebar.operators.windows import intraday_vwap

    priced = intraday_vwap(_bands(t), tie="volume")
    out = i.breakout_signals(priced, minutes=(0,), invert=True)
    return out.select("symbol", "timestamp", "signal", F.round("stop", 6).alias("stop"))
