"""Queries: window operators and gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebar.functions.calendars import HOLIDAYS
from tidebar.operators import gaps as g
from tidebar.operators import windows as w
from tidebar.plans.register import query
from tidebar.sources.adapters import Tables

RECENT = "timestamp >= (SELECT max(timestamp) FROM bars) - INTERVAL 30 DAY"
BY = "OVER (PARTITION BY symbol ORDER BY timestamp)"
HOLIDAY_LIST = ", ".join(f"DATE '{h}'" for h in HOLIDAYS)


@query("market_statistics", f"""SELECT symbol, timestamp, close, round(p, 6) AS price_change_pct, round(v, 6) AS volume_change_pct, CASE WHEN p > 0 AND v > 0 THEN 'STRONG_UP' WHEN p > 0 THEN 'WEAK_UP' WHEN p < 0 AND v > 0 THEN 'STRONG_DOWN' WHEN p < 0 THEN 'WEAK_DOWN' ELSE 'NEUTRAL' END AS label
    FROM (SELECT *, (close - lag(close) {BY}) * 100.0 / lag(close) {BY} AS p, (volume - lag(volume) {BY}) * 100.0::DOUBLE / lag(volume) {BY} AS v FROM bars) WHERE {RECENT}""")
def _(t: Tables):
    return w.market_statistics(t.bars)


@query("momentum", f"SELECT * FROM (SELECT symbol, timestamp, close, {', '.join(f'round((close - lag(close, {n}) {BY}) * 100.0 / lag(close, {n}) {BY}, 6) AS momentum_{n}' for n in (5, 10, 20))} FROM bars) WHERE {RECENT}")
def _(t: Tables):
    return w.momentum(t.bars)


@query("rolling_volatility", f"SELECT symbol, timestamp, round(stddev_samp(lr) OVER (PARTITION BY symbol ORDER BY timestamp ROWS 19 PRECEDING) * sqrt(252.0), 6) AS volatility FROM (SELECT *, ln(close / lag(close) {BY}) AS lr FROM bars)")
def _(t: Tables):
    return w.rolling_volatility(t.bars)


@query("depth_stats", f"""SELECT symbol, timestamp, spread_pct, volume_trend, CASE WHEN spread_pct < 1 THEN 'TIGHT' WHEN spread_pct < 5 THEN 'NORMAL' ELSE 'WIDE' END AS depth
    FROM (SELECT *, round((high - low) * 100.0 / nullif(close, 0), 6) AS spread_pct, volume - lag(volume) {BY} AS volume_trend FROM bars) WHERE {RECENT}""")
def _(t: Tables):
    return w.depth_stats(t.bars)


@query("price_jumps", f"SELECT * FROM (SELECT symbol, timestamp, close, round((close - lag(close) {BY}) * 100.0 / nullif(lag(close) {BY}, 0), 6) AS change_pct FROM bars) WHERE abs(change_pct) > 5")
def _(t: Tables):
    return w.price_jumps(t.bars)


_FRONT = "SELECT root, timestamp, arg_min(symbol, expiry_month) AS underlying_symbol FROM contract_bars GROUP BY root, timestamp"


@query("rollover_events", f"SELECT root, timestamp, f AS from_contract, underlying_symbol AS to_contract FROM (SELECT *, lag(underlying_symbol) OVER (PARTITION BY root ORDER BY timestamp) AS f FROM ({_FRONT})) WHERE f <> underlying_symbol")
def _(t: Tables):
    front = t.contract_bars.groupBy("root", "timestamp").agg(F.min_by("symbol", "expiry_month").alias("underlying_symbol"))
    return w.rollover_events(front)


_ROLLS = "SELECT root, symbol AS contract, last_date - 5 AS roll_date, 'calendar' AS roll_type FROM contracts UNION ALL SELECT root, symbol AS contract, last_date - 5 AS roll_date, 'volume' AS roll_type FROM contracts WHERE days % 2 = 0"


@query("preferred_roll_dedup", f"""SELECT root, contract, roll_date, roll_type, lead(contract) OVER (PARTITION BY root ORDER BY roll_date, contract) AS to_contract FROM (SELECT * FROM ({_ROLLS})
    QUALIFY row_number() OVER (PARTITION BY root, contract, roll_date ORDER BY CASE WHEN roll_type = 'volume' THEN 0 ELSE 1 END, roll_type) = 1)""")
def _(t: Tables):
    base = t.contracts.select("root", F.col("symbol").alias("contract"), F.date_sub("last_date", 5).alias("roll_date"), "days")
    rolls = base.withColumn("roll_type", F.lit("calendar")).union(base.where("days % 2 = 0").withColumn("roll_type", F.lit("volume"))).drop("days")
    return w.preferred_roll_dedup(rolls)


@query("centred_band", "SELECT symbol, timestamp, round(avg(close) OVER w, 6) AS band_mean, round(stddev_samp(close) OVER w, 6) AS band_std FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING)")
def _(t: Tables):
    return w.centred_band(t.bars).select("symbol", "timestamp", F.round("band_mean", 6).alias("band_mean"), F.round("band_std", 6).alias("band_std"))


@query("whole_partition_zscore", "SELECT symbol, timestamp, round((close - avg(close) OVER w) / nullif(stddev_samp(close) OVER w, 0), 6) AS zscore FROM bars WINDOW w AS (PARTITION BY symbol)")
def _(t: Tables):
    return w.partition_zscore(t.bars, "close").select("symbol", "timestamp", F.round("zscore", 6).alias("zscore"))


@query("lead_lag_midpoint", f"SELECT symbol, timestamp, coalesce(open, (lag(open) {BY} + lead(open) {BY}) / 2) AS open FROM dirty_bars")
def _(t: Tables):
    return w.neighbour_midpoint(t.dirty_bars, "open").select("symbol", "timestamp", "open")


@query("source_transition", f"SELECT symbol, timestamp, source, source IS DISTINCT FROM before AND before IS NOT NULL AS changed FROM (SELECT *, lag(source) {BY} AS before FROM bars)")
def _(t: Tables):
    return w.source_transition(t.bars).select("symbol", "timestamp", "source", "changed")


@query("intraday_vwap", """SELECT id, round(CASE WHEN s THEN sum(CASE WHEN s THEN close * volume END) OVER w / nullif(sum(CASE WHEN s THEN volume END) OVER w, 0) ELSE close END, 6) AS vwap FROM (SELECT *, strftime(timestamp, '%H:%M') >= '09:30' AND strftime(timestamp, '%H:%M') < '16:00' AS s FROM ticks)
    WINDOW w AS (PARTITION BY symbol, CAST(timestamp AS DATE) ORDER BY timestamp, id ROWS UNBOUNDED PRECEDING)""")
def _(t: Tables):
    return w.intraday_vwap(t.ticks).select("id", F.round("vwap", 6).alias("vwap"))


@query("running_peak", f"SELECT symbol, timestamp, max(close) {BY} AS peak FROM bars")
def _(t: Tables):
    return w.running_peak(t.bars, "close").select("symbol", "timestamp", "peak")


@query("running_product", f"SELECT symbol, timestamp, round(exp(sum(ln(1 + coalesce(ret, 0))) {BY}), 4) AS growth FROM (SELECT *, close / lag(close) {BY} - 1 AS ret FROM bars)")
def _(t: Tables):
    from tidebar.functions.scalars import by_symbol

    ret = F.col("close") / F.lag("close").over(by_symbol()) - 1
    return w.running_product(t.bars.withColumn("ret", ret), "ret").select("symbol", "timestamp", F.round("growth", 4).alias("growth"))


@query("forward_fill", "SELECT symbol, timestamp, last_value(open IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS open FROM dirty_bars")
def _(t: Tables):
    return w.fill(t.dirty_bars, ["open"]).select("symbol", "timestamp", "open")


@query("back_fill", "SELECT symbol, timestamp, first_value(open IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM dirty_bars")
def _(t: Tables):
    return w.fill(t.dirty_bars, ["open"], "backward").select("symbol", "timestamp", "open")


@query("seasonal_rolling_mean", "SELECT symbol, timestamp, CASE WHEN count(close) OVER w >= 5 THEN round(avg(close) OVER w, 6) END AS seasonal_mean FROM (SELECT symbol, date_trunc('hour', timestamp) AS timestamp, round(avg(close), 6) AS close FROM ticks GROUP BY 1, 2) WINDOW w AS (PARTITION BY symbol, hour(timestamp) ORDER BY timestamp ROWS 13 PRECEDING)")
def _(t: Tables):
    hourly = t.ticks.groupBy("symbol", F.date_trunc("hour", "timestamp").alias("timestamp")).agg(F.round(F.avg("close"), 6).alias("close"))
    return w.seasonal_rolling_mean(hourly, "close").select("symbol", "timestamp", F.round("seasonal_mean", 6).alias("seasonal_mean"))


_DAYS = "SELECT symbol, CAST(timestamp AS DATE) AS gap_start, lead(CAST(timestamp AS DATE)) OVER (PARTITION BY symbol ORDER BY timestamp) AS gap_end FROM bars"
_GAPS = f"SELECT *, date_diff('day', gap_start, gap_end) - 1 AS gap_days FROM ({_DAYS}) WHERE date_diff('day', gap_start, gap_end) > 1"
_MISSING = "len(list_filter(generate_series(gap_start + 1, gap_end - 1, INTERVAL 1 DAY), lambda d: dayofweek(d) NOT IN (0, 6)))"
_HOLIDAY = f"len(list_filter(generate_series(gap_start + 1, gap_end - 1, INTERVAL 1 DAY), lambda d: dayofweek(d) NOT IN (0, 6) AND CAST(d AS DATE) NOT IN ({HOLIDAY_LIST})))"
_BUSINESS = f"SELECT * FROM (SELECT *, {_MISSING} AS missing_days FROM ({_GAPS})) WHERE missing_days > 0"
GAP_CTES = {"gap_rows": _GAPS, "gap_business": _BUSINESS}


@query("gaps_basic", "SELECT * FROM gap_rows", GAP_CTES)
def _(t: Tables):
    return g.gaps(t.bars)


@query("gaps_weekend_aware", "SELECT * FROM gap_business", GAP_CTES)
def _(t: Tables):
    return g.gaps_business(t.bars)


@query("gaps_holiday_aware", f"SELECT * FROM (SELECT *, {_HOLIDAY} AS missing_days FROM gap_rows) WHERE missing_days > 0", GAP_CTES)
def _(t: Tables):
    return g.gaps_business(t.bars, HOLIDAYS)


@query("gap_summary", "SELECT symbol, count(*) AS gaps, CAST(sum(missing_days) AS BIGINT) AS total_missing, round(avg(missing_days), 6) AS avg_missing, max(missing_days) AS max_missing FROM gap_business GROUP BY symbol", GAP_CTES)
def _(t: Tables):
    return g.gap_summary(t.bars)


@query("recent_gaps", "SELECT * FROM gap_business WHERE gap_end >= (SELECT CAST(max(timestamp) AS DATE) FROM bars) - 90", GAP_CTES)
def _(t: Tables):
    return g.recent_gaps(t.bars)


@query("time_continuity", f"SELECT * FROM (SELECT symbol, timestamp, lead(timestamp) {BY} AS next_timestamp, round(date_diff('microsecond', timestamp, lead(timestamp) {BY}) / 1e6 / 86400, 6) AS gap FROM bars) WHERE gap > 1")
def _(t: Tables):
    return g.time_continuity(t.bars)


@query("coverage", f"""SELECT symbol, count(DISTINCT CAST(timestamp AS DATE)) AS actual_days, any_value(n) AS expected_days, round(count(DISTINCT CAST(timestamp AS DATE)) * 100.0::DOUBLE / any_value(n), 6) AS coverage_pct FROM bars,
    (SELECT count(*) AS n FROM (SELECT unnest(generate_series((SELECT min(timestamp)::DATE FROM bars), (SELECT max(timestamp)::DATE FROM bars), INTERVAL 1 DAY)) AS d) WHERE dayofweek(d) NOT IN (0, 6) AND CAST(d AS DATE) NOT IN ({HOLIDAY_LIST})) GROUP BY symbol""")
def _(t: Tables):
    return g.coverage(t.bars, HOLIDAYS)


@query("interval_gaps", f"""SELECT symbol, timestamp AS gap_start, after AS gap_end, round(date_diff('microsecond', timestamp, after) / 1e6, 6) AS duration_s, CAST(round(date_diff('microsecond', timestamp, after) / 1e6 / 3600) - 1 AS BIGINT) AS missing_points
    FROM (SELECT *, lead(timestamp) OVER (PARTITION BY symbol ORDER BY timestamp) AS after FROM (SELECT DISTINCT symbol, timestamp FROM ticks)) WHERE date_diff('microsecond', timestamp, after) / 1e6 > 5400""")
def _(t: Tables):
    return g.interval_gaps(t.ticks.select("symbol", "timestamp").distinct(), 3600)


@query("intraday_gaps", "SELECT * FROM (SELECT symbol, lag(timestamp) OVER w AS previous, timestamp, round(date_diff('microsecond', lag(timestamp) OVER w, timestamp) / 1e6 / 60, 6) AS gap_minutes FROM (SELECT DISTINCT symbol, timestamp FROM ticks) WINDOW w AS (PARTITION BY symbol ORDER BY timestamp)) WHERE gap_minutes > 30")
def _(t: Tables):
    return g.intraday_gaps(t.ticks.select("symbol", "timestamp").distinct())


@query("missing_business_days", "SELECT symbol, CAST(d AS DATE) AS date FROM (SELECT symbol, unnest(generate_series(min(timestamp)::DATE, max(timestamp)::DATE, INTERVAL 1 DAY)) AS d FROM bars GROUP BY symbol) WHERE dayofweek(d) NOT IN (0, 6) AND (symbol, CAST(d AS DATE)) NOT IN (SELECT (symbol, timestamp::DATE) FROM bars)")
def _(t: Tables):
    return g.missing_business_days(t.bars)


@query("trading_day_gaps", """WITH cal AS (SELECT d, row_number() OVER (ORDER BY d) AS o FROM (SELECT DISTINCT timestamp::DATE AS d FROM bars WHERE dayofweek(timestamp) NOT IN (0, 6)))
    SELECT symbol, d AS gap_start, e AS gap_end, p - o - 1 AS trading_days FROM (SELECT symbol, d, o, lead(d) OVER w AS e, lead(o) OVER w AS p FROM (SELECT DISTINCT symbol, timestamp::DATE AS day FROM bars) JOIN cal ON day = d WINDOW w AS (PARTITION BY symbol ORDER BY d)) WHERE p - o - 1 > 2""")
def _(t: Tables):
    from tidebar.functions.calendars import with_ordinal

    days = t.bars.select(F.to_date("timestamp").alias("date")).where(F.weekday("date") < 5).distinct()
    return g.trading_day_gaps(t.bars, with_ordinal(days))


@query("missing_contracts", """SELECT symbol FROM (SELECT r || substr('FGHJKMNQUVXZ', m, 1) || right(CAST(y AS VARCHAR), 2) AS symbol FROM (SELECT DISTINCT root AS r FROM contracts), (SELECT unnest(range(1994, 2004)) AS y), (SELECT unnest(range(1, 13)) AS m)) EXCEPT SELECT symbol FROM contracts""")
def _(t: Tables):
    from tidebar.functions.symbols import contract_codes

    return g.missing_contracts(t.contracts, contract_codes(t.contracts.select("root").distinct(), range(1994, 2004)))


@query("missing_vs_reference", """SELECT k.root, r.date, CAST(p AS INT) AS position, strftime(r.date, '%a') AS weekday, CAST(month(r.date) AS INT) AS month FROM (SELECT DISTINCT timestamp::DATE AS date FROM bars WHERE symbol = 'Brand#1') r, (SELECT DISTINCT root FROM contract_bars) k, (SELECT unnest(range(1, 6)) AS p)
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT root, timestamp::DATE AS date, dense_rank() OVER (PARTITION BY root, timestamp ORDER BY expiry_month) AS position FROM contract_bars) s WHERE s.root = k.root AND s.date = r.date AND s.position = p)""")
def _(t: Tables):
    from pyspark.sql import Window

    reference = t.bars.where("symbol = 'Brand#1'").select(F.to_date("timestamp").alias("date"), F.col("close").alias("value"))
    rank = F.dense_rank().over(Window.partitionBy("root", "timestamp").orderBy("expiry_month"))
    series = t.contract_bars.select("root", F.to_date("timestamp").alias("date"), rank.alias("position"), F.col("close").alias("value"))
    return g.missing_vs_reference(reference, series, 5)


@query("missing_intervals", "SELECT symbol, u AS interval_unit FROM (SELECT DISTINCT symbol FROM bars), (VALUES ('daily'), ('minute')) v(u) WHERE u NOT IN (SELECT interval_unit FROM bars)")
def _(t: Tables):
    config = t.bars.select("symbol").distinct().withColumn("interval_unit", F.explode(F.array(F.lit("daily"), F.lit("minute"))))
    return g.missing_intervals(t.bars, config)
