"""Queries: joins that other operators use, by themselves, and the registries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebar.functions.calendars import HOLIDAYS
from tidebar.operators import gaps, indicators, risk
from tidebar.plans.p_indicators import smoothed
from tidebar.plans.p_windows import GAP_CTES, HOLIDAY_LIST
from tidebar.plans.register import query
from tidebar.sources.adapters import Tables

BY = "OVER (PARTITION BY symbol ORDER BY timestamp)"


@query("benchmark_join", f"WITH r AS (SELECT symbol, timestamp, round(close / lag(close) {BY} - 1, 6) AS ret FROM bars) SELECT a.symbol, a.timestamp, a.ret, b.ret AS market FROM r a JOIN r b ON a.timestamp = b.timestamp WHERE b.symbol = 'Brand#1' AND a.ret IS NOT NULL AND b.ret IS NOT NULL")
def _(t: Tables):
    rets = risk.returns(t.bars).where("ret IS NOT NULL").select("symbol", "timestamp", F.round("ret", 6).alias("ret"))
    # one symbol of many is the smaller side by far; the session's threshold decides whether it is broadcast
    return rets.join(rets.where("symbol = 'Brand#1'").select("timestamp", F.col("ret").alias("market")), "timestamp")


@query("holiday_range_join", f"SELECT symbol, gap_start, gap_end, len(list_filter([{HOLIDAY_LIST}, DATE '1996-07-04', DATE '1997-07-04'], lambda h: h > gap_start AND h < gap_end)) AS holidays FROM gap_rows WHERE len(list_filter([{HOLIDAY_LIST}, DATE '1996-07-04', DATE '1997-07-04'], lambda h: h > gap_start AND h < gap_end)) > 0", GAP_CTES)
def _(t: Tables):
    days = gaps.holiday_array((*HOLIDAYS, "1996-07-04", "1997-07-04"))
    inside = F.size(F.filter(days, lambda h: (h > F.col("gap_start")) & (h < F.col("gap_end"))))
    return gaps.gaps(t.bars).select("symbol", "gap_start", "gap_end", inside.cast("long").alias("holidays")).where("holidays > 0")


@query("coverage_scalar_subquery", "SELECT symbol, count(DISTINCT timestamp::DATE) AS actual_days, (SELECT count(*) FROM (SELECT unnest(generate_series((SELECT min(timestamp)::DATE FROM bars), (SELECT max(timestamp)::DATE FROM bars), INTERVAL 1 DAY)) AS d) WHERE dayofweek(d) NOT IN (0, 6)) AS expected_days FROM bars GROUP BY symbol")
def _(t: Tables):
    return gaps.coverage(t.bars).select("symbol", "actual_days", "expected_days")


@query("gap_fill_join", "SELECT a.timestamp, a.close AS reference FROM bars a LEFT JOIN (SELECT timestamp, close FROM bars WHERE symbol = 'Brand#2') b ON a.timestamp = b.timestamp WHERE a.symbol = 'Brand#1' AND b.close IS NULL")
def _(t: Tables):
    target = t.bars.where("symbol = 'Brand#2'").select("timestamp", F.col("close").alias("own"))
    return t.bars.where("symbol = 'Brand#1'").join(target, "timestamp", "left").where("own IS NULL").select("timestamp", F.col("close").alias("reference"))


@query("indicator_registry", f"SELECT symbol, timestamp, 'sma_20' AS indicator_name, round(v, 6) AS value FROM (SELECT symbol, timestamp, CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END AS v FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS 19 PRECEDING)) WHERE v IS NOT NULL")
def _(t: Tables):
    return indicators.indicators_long(t.bars.select("symbol", "timestamp", "close"), ["sma"]).select("symbol", "timestamp", "indicator_name", F.round("value", 6).alias("value"))


@query("ewm", "SELECT symbol, timestamp, close, round(e, 6) AS smooth FROM ewm_rows", {"ewm_rows": smoothed("bars", "close", 0.1)})
def _(t: Tables):
    return indicators.ewm(t.bars.select("symbol", "timestamp", "close"), {"smooth": ("close", 0.1)}).withColumn("smooth", F.round("smooth", 6))
