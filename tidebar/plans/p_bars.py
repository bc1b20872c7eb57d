"""Queries: resampling, inventories and grouped aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebar.operators import bars as b
from tidebar.plans.register import query
from tidebar.sources.adapters import Tables

BAR = "arg_min(open, {o}) AS open, max(high) AS high, min(low) AS low, arg_max(close, {o}) AS close, CAST(sum(volume) AS BIGINT) AS volume"
TICK = BAR.format(o="{'a': timestamp, 'b': id}")
DAY = BAR.format(o="timestamp")
SPAN = "CAST(min(timestamp) AS DATE) AS first_date, CAST(max(timestamp) AS DATE) AS last_date, count(*) AS n, date_diff('day', min(timestamp), max(timestamp)) AS span_days"


@query("weekly_bars", f"SELECT symbol, CAST(date_trunc('week', timestamp) AS TIMESTAMP) AS timestamp, {DAY} FROM bars GROUP BY symbol, date_trunc('week', timestamp)")
def _(t: Tables):
    return b.resample(t.bars, "week")


@query("daily_bars", f"SELECT symbol, CAST(date_trunc('day', timestamp) AS TIMESTAMP) AS timestamp, {TICK} FROM ticks GROUP BY symbol, date_trunc('day', timestamp)")
def _(t: Tables):
    return b.resample(t.ticks, "day", tie="id")


@query("five_minute_bars", f"SELECT symbol, time_bucket(INTERVAL 5 MINUTE, timestamp) AS timestamp, {TICK} FROM ticks GROUP BY symbol, time_bucket(INTERVAL 5 MINUTE, timestamp)")
def _(t: Tables):
    return b.resample(t.ticks, "5 minutes", tie="id")


@query("monthly_bars", f"SELECT symbol, CAST(date_trunc('month', timestamp) AS TIMESTAMP) AS timestamp, {DAY} FROM bars GROUP BY symbol, date_trunc('month', timestamp)")
def _(t: Tables):
    return b.resample(t.bars, "month")


@query("resample_last_daily", "SELECT symbol, CAST(timestamp AS DATE) AS date, arg_max(close, {'a': timestamp, 'b': id}) AS close FROM ticks GROUP BY 1, 2")
def _(t: Tables):
    return b.resample_last(t.ticks)


@query("session_stats", """SELECT symbol, CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INT) AS hour, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume, round(avg(close), 6) AS avg_close, round(max(high) - min(low), 6) AS range
    FROM ticks WHERE timestamp >= (SELECT max(timestamp) FROM ticks) - INTERVAL 30 DAY GROUP BY 1, 2, 3""")
def _(t: Tables):
    return b.session_stats(t.ticks)


@query("market_breadth", """SELECT timestamp, count(DISTINCT symbol) AS total, count(DISTINCT CASE WHEN close > open THEN symbol END) AS advancing, count(DISTINCT CASE WHEN close < open THEN symbol END) AS declining,
    count(DISTINCT CASE WHEN close = open THEN symbol END) AS unchanged, round(count(DISTINCT CASE WHEN close > open THEN symbol END)::DOUBLE / nullif(count(DISTINCT CASE WHEN close < open THEN symbol END), 0), 6) AS ratio
    FROM bars WHERE timestamp >= (SELECT max(timestamp) FROM bars) - INTERVAL 30 DAY GROUP BY timestamp""")
def _(t: Tables):
    return b.market_breadth(t.bars)


@query("price_decile", "SELECT symbol, timestamp, CAST(ntile(10) OVER (PARTITION BY symbol ORDER BY close, timestamp) AS INT) AS decile FROM bars")
def _(t: Tables):
    return b.price_decile(t.bars).select("symbol", "timestamp", "decile")


@query("price_distribution", """SELECT symbol, CAST(decile AS INT) AS decile, min(close) AS min_close, max(close) AS max_close, round(avg(close), 6) AS avg_close, count(*) AS n FROM (SELECT symbol, close, ntile(10) OVER (PARTITION BY symbol ORDER BY close, timestamp) AS decile
    FROM bars WHERE timestamp >= (SELECT max(timestamp) FROM bars) - INTERVAL 365 DAY) GROUP BY symbol, decile""")
def _(t: Tables):
    return b.price_distribution(t.bars)


@query("symbol_inventory", f"SELECT symbol, {SPAN} FROM bars GROUP BY symbol")
def _(t: Tables):
    return b.inventory(t.bars, "symbol")


@query("stale_symbols", f"SELECT * FROM (SELECT symbol, {SPAN} FROM contract_bars GROUP BY symbol) WHERE date_diff('day', last_date, (SELECT max(timestamp) FROM contract_bars)) > 7")
def _(t: Tables):
    return b.stale_symbols(t.contract_bars)


@query("recent_symbols", "SELECT symbol, max(timestamp) AS last FROM bars GROUP BY symbol ORDER BY last DESC, symbol LIMIT 20")
def _(t: Tables):
    return b.recent_symbols(t.bars)


@query("interval_counts", "SELECT interval_value, interval_unit, count(DISTINCT symbol) AS symbols, count(*) AS n FROM bars GROUP BY ALL")
def _(t: Tables):
    return b.interval_counts(t.bars)


@query("symbol_interval_inventory", f"SELECT symbol, interval_value, interval_unit, {SPAN} FROM bars GROUP BY symbol, interval_value, interval_unit")
def _(t: Tables):
    return b.inventory(t.bars, "symbol", "interval_value", "interval_unit")


@query("monthly_density", "SELECT CAST(date_trunc('month', timestamp) AS TIMESTAMP) AS month, count(DISTINCT symbol) AS symbols, count(*) AS n FROM bars GROUP BY 1")
def _(t: Tables):
    return b.monthly_density(t.bars)


@query("continuous_inventory", f"SELECT root, 'unadjusted' AS built_by, false AS adjusted, {SPAN} FROM contract_bars GROUP BY root")
def _(t: Tables):
    return b.inventory(t.contract_bars.withColumns({"built_by": F.lit("unadjusted"), "adjusted": F.lit(False)}), "root", "built_by", "adjusted")


@query("combined_inventory", f"""SELECT origin, symbol, {SPAN} FROM (SELECT 'daily' AS origin, symbol, timestamp FROM bars UNION ALL SELECT 'tick' AS origin, symbol, timestamp FROM ticks
    UNION ALL SELECT 'contract' AS origin, symbol, timestamp FROM contract_bars) GROUP BY origin, symbol""")
def _(t: Tables):
    of = lambda df, name: df.select(F.lit(name).alias("origin"), "symbol", "timestamp")
    return b.inventory(of(t.bars, "daily").unionByName(of(t.ticks, "tick")).unionByName(of(t.contract_bars, "contract")), "origin", "symbol")


@query("contract_details", "SELECT symbol, count(*) AS n, CAST(min(timestamp) AS DATE) AS first_date, CAST(max(timestamp) AS DATE) AS last_date, round(avg(high - low), 4) AS avg_range FROM contract_bars GROUP BY symbol")
def _(t: Tables):
    return b.contract_details(t.contract_bars)


@query("contract_span", f"SELECT symbol, {SPAN} FROM contract_bars WHERE regexp_matches(symbol, '[FGHJKMNQUVXZ][0-9]{{2}}$') GROUP BY symbol")
def _(t: Tables):
    return b.inventory(t.contract_bars.where(F.col("symbol").rlike("[FGHJKMNQUVXZ][0-9]{2}$")), "symbol")


@query("purge_candidates", f"""SELECT * FROM (SELECT *, CASE WHEN year(last_date) < 1996 THEN 'OLD' WHEN n < 30 THEN 'FEW_ROWS' END AS reason FROM (SELECT symbol, {SPAN} FROM contract_bars
    WHERE regexp_matches(symbol, '^[A-Z]+[FGHJKMNQUVXZ][0-9]{{2}}$') GROUP BY symbol)) WHERE reason IS NOT NULL""")
def _(t: Tables):
    return b.purge_candidates(t.contract_bars, 1996, 30, "^[A-Z]+[FGHJKMNQUVXZ][0-9]{2}$")


_POSITIONS = "SELECT root, CAST(timestamp AS DATE) AS date, dense_rank() OVER (PARTITION BY root, timestamp ORDER BY expiry_month) AS position FROM contract_bars"


@query("series_completeness", f"""SELECT root, date, count(DISTINCT CASE WHEN position BETWEEN 1 AND 5 THEN position END) AS present, coalesce(string_agg(DISTINCT CASE WHEN position BETWEEN 1 AND 5 THEN CAST(position AS VARCHAR) END, ',' ORDER BY CASE WHEN position BETWEEN 1 AND 5 THEN CAST(position AS VARCHAR) END), '') AS positions,
    count(DISTINCT CASE WHEN position BETWEEN 1 AND 5 THEN position END) = 5 AS complete FROM ({_POSITIONS}) GROUP BY root, date""")
def _(t: Tables):
    from pyspark.sql import Window

    rank = F.dense_rank().over(Window.partitionBy("root", "timestamp").orderBy("expiry_month"))
    cont = t.contract_bars.select("root", F.to_date("timestamp").alias("date"), rank.alias("position"))
    return b.series_completeness(cont, 5)


#: The name of a holiday by month m, day d and weekday w (1: Monday).
_HOLIDAY = """CASE
    WHEN m = 1 AND d = 1 THEN 'New Year'
    WHEN m = 1 AND w = 1 AND d BETWEEN 15 AND 21 THEN 'Martin Luther King Day'
    WHEN m = 2 AND w = 1 AND d BETWEEN 15 AND 21 THEN 'Presidents Day'
    WHEN m = 5 AND w = 1 AND d >= 25 THEN 'Memorial Day'
    WHEN m = 6 AND d = 19 THEN 'Juneteenth'
    WHEN m = 7 AND d = 4 THEN 'Independence Day'
    WHEN m = 9 AND w = 1 AND d <= 7 THEN 'Labor Day'
    WHEN m = 11 AND w = 4 AND d BETWEEN 22 AND 28 THEN 'Thanksgiving'
    WHEN m = 12 AND d = 25 THEN 'Christmas' END"""


@query("missing_pattern_counts", f"""SELECT CAST(coalesce(year, -1) AS INT) AS year, CAST(coalesce(month, -1) AS INT) AS month, CAST(coalesce(weekday, -1) AS INT) AS weekday, coalesce(holiday, '') AS holiday, count(*) AS n FROM (SELECT year, m AS month, w - 1 AS weekday, coalesce({_HOLIDAY}, 'none') AS holiday FROM
    (SELECT year(timestamp) AS year, month(timestamp) AS m, day(timestamp) AS d, isodow(timestamp) AS w FROM dirty_bars WHERE open IS NULL)) GROUP BY GROUPING SETS ((year), (month), (weekday), (holiday))""")
def _(t: Tables):
    return b.missing_patterns(t.dirty_bars.where("open IS NULL").select(F.to_date("timestamp").alias("date")))


_TRADES = "SELECT CAST(timestamp AS DATE) AS date, (close - 50.0) * volume AS pnl, 5.0::DOUBLE * volume AS costs FROM ticks"


@query("trades_daily", f"""WITH d AS (SELECT date, sum(pnl) AS pnl, sum(costs) AS costs, count(*) AS trades, round(avg(CASE WHEN pnl > costs THEN 1.0 ELSE 0.0 END), 6) AS win_rate FROM ({_TRADES}) GROUP BY date),
    e AS (SELECT *, 100000.0 + sum(pnl - costs) OVER (ORDER BY date) AS equity FROM d), f AS (SELECT *, equity / coalesce(lag(equity) OVER (ORDER BY date), 100000.0) - 1 AS return, max(equity) OVER (ORDER BY date) AS peak FROM e)
    SELECT date, round(pnl, 2) AS pnl, round(costs, 2) AS costs, trades, win_rate, round(equity, 2) AS equity, round(return, 6) AS return, round(peak, 2) AS peak, round(equity / peak, 6) - 1 AS drawdown FROM f""")
def _(t: Tables):
    return b.trades_daily(t.ticks.select(F.to_date("timestamp").alias("date"), ((F.col("close") - 50.0) * F.col("volume")).alias("pnl"), (5.0 * F.col("volume")).alias("costs")))


@query("position_daily", """SELECT symbol, CAST(timestamp AS DATE) AS date, arg_max(p, {'a': timestamp, 'b': id}) AS last_position, max(abs(p)) AS max_position, round(avg(CASE WHEN p <> 0 THEN abs(p) END), 6) AS avg_position FROM (SELECT *, CAST(id % 7 AS BIGINT) - 3 AS p FROM ticks) GROUP BY 1, 2""")
def _(t: Tables):
    return b.position_daily(t.ticks.withColumn("position", F.col("id") % 7 - 3))


@query("key_uniqueness", "SELECT symbol, timestamp, count(*) AS n FROM fills_by_time GROUP BY symbol, timestamp HAVING n > 1", {"fills_by_time": "SELECT symbol, ts AS timestamp FROM fills"})
def _(t: Tables):
    return b.key_uniqueness(t.fills.withColumnRenamed("ts", "timestamp"), ["symbol", "timestamp"])


@query("yearly_counts", "SELECT symbol, CAST(year(timestamp) AS INT) AS year, count(*) AS n FROM bars GROUP BY 1, 2")
def _(t: Tables):
    return b.yearly_counts(t.bars)


@query("latest_prices", "SELECT symbol, max(timestamp) AS timestamp, arg_max(close, timestamp) AS close, arg_max(volume, timestamp) AS volume FROM bars GROUP BY symbol")
def _(t: Tables):
    return b.latest_prices(t.bars)


@query("daily_open_close", """SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev_close FROM (SELECT symbol, CAST(timestamp AS DATE) AS date, arg_min(open, {'a': timestamp, 'b': id}) AS open, arg_max(close, {'a': timestamp, 'b': id}) AS close FROM ticks GROUP BY 1, 2)""")
def _(t: Tables):
    return b.daily_open_close(t.ticks)


@query("monthly_avg_volume", "SELECT symbol, CAST(date_trunc('month', timestamp) AS TIMESTAMP) AS period, round(avg(volume), 6) AS avg_volume FROM bars GROUP BY 1, 2")
def _(t: Tables):
    return b.avg_volume(t.bars)


@query("weekly_extremes", "SELECT symbol, CAST(date_trunc('week', timestamp) AS TIMESTAMP) AS period, max(high) AS highest, min(low) AS lowest FROM bars GROUP BY 1, 2")
def _(t: Tables):
    return b.extremes(t.bars)


@query("symbol_statistics", "SELECT symbol, count(*) AS n, count(DISTINCT CAST(timestamp AS DATE)) AS days, min(timestamp) AS first, max(timestamp) AS last FROM ticks GROUP BY symbol")
def _(t: Tables):
    return b.symbol_statistics(t.ticks)


@query("roll_dates_summary", "SELECT root, 'calendar' AS roll_type, count(*) AS n, min(last_date - 5) AS first_roll, max(last_date - 5) AS last_roll FROM contracts GROUP BY root")
def _(t: Tables):
    return b.roll_dates_summary(t.contracts.select("root", F.lit("calendar").alias("roll_type"), F.date_sub("last_date", 5).alias("roll_date")))
