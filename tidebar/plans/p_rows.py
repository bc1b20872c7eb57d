"""Queries: projections, filters, predicates, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebar.operators import bars, rows
from tidebar.plans.register import query
from tidebar.sources.adapters import Tables

RECENT = "timestamp >= (SELECT max(timestamp) FROM bars) - INTERVAL 30 DAY"


@query("retrieve", f"SELECT symbol, count(close) AS count_close, max(high) AS max_high FROM bars WHERE symbol IN ('Brand#1', 'Brand#2', 'Brand#3') AND timestamp >= (SELECT max(timestamp) FROM bars WHERE symbol IN ('Brand#1', 'Brand#2', 'Brand#3')) - INTERVAL 30 DAY GROUP BY symbol")
def _(t: Tables):
    return rows.retrieve(t.bars, symbols=["Brand#1", "Brand#2", "Brand#3"], aggregates={"close": "count", "high": "max"}, group_by=["symbol"])


@query("retrieve_by_type", """SELECT symbol, timestamp, close FROM (SELECT symbol, time_bucket(INTERVAL 5 MINUTE, timestamp) AS timestamp, arg_max(close, {'a': timestamp, 'b': id}) AS close FROM ticks GROUP BY ALL) WHERE timestamp >= (SELECT max(time_bucket(INTERVAL 5 MINUTE, timestamp)) FROM ticks) - INTERVAL 3 DAY""")
def _(t: Tables):
    catalog = {"daily_bars": lambda: t.bars, "five_minute_bars": lambda: bars.resample(t.ticks, "5 minutes", tie="id"), "economic_data": lambda: t.econ}
    return rows.retrieve_from(catalog, "market_data", "five_minute_bars", fields=["symbol", "timestamp", "close"])


@query("minute_bars", "SELECT symbol, timestamp, close FROM (SELECT *, CASE WHEN id % 2 = 0 THEN 'minute' ELSE 'tick' END AS interval_unit, id % 3 AS interval_value FROM ticks) WHERE interval_unit = 'minute' AND interval_value = 1")
def _(t: Tables):
    marked = t.ticks.withColumns({"interval_unit": F.when(F.col("id") % 2 == 0, "minute").otherwise("tick"), "interval_value": F.col("id") % 3})
    return rows.minute_bars(marked, 1).select("symbol", "timestamp", "close")


@query("open_orders", "SELECT * FROM acct_orders WHERE status IN ('Open', 'PartiallyFilled')")
def _(t: Tables):
    return rows.open_orders(t.acct_orders)


@query("symbol_list", "SELECT DISTINCT symbol FROM bars")
def _(t: Tables):
    return rows.symbol_list(t.bars)


@query("symbols_like", "SELECT DISTINCT symbol FROM bars WHERE symbol LIKE 'Brand#1%'")
def _(t: Tables):
    return rows.symbols_like(t.bars, "Brand#1%")


@query("symbols_regex", "SELECT DISTINCT symbol FROM contract_bars WHERE regexp_matches(symbol, '^[A-Z]{5}[FGHJKMNQUVXZ][0-9]{2}$')")
def _(t: Tables):
    return rows.symbols_regex(t.contract_bars, "^[A-Z]{5}[FGHJKMNQUVXZ][0-9]{2}$")


@query("low_quality_rows", "SELECT symbol, timestamp, quality FROM bars WHERE quality < 90 AND interval_unit = 'daily'")
def _(t: Tables):
    return rows.low_quality(t.bars).select("symbol", "timestamp", "quality")


@query("ohlc_inconsistent", "SELECT symbol, timestamp, open, high, low, close FROM dirty_bars WHERE high < open OR high < close OR high < low OR low > open OR low > close")
def _(t: Tables):
    return rows.ohlc_inconsistent(t.dirty_bars).select("symbol", "timestamp", "open", "high", "low", "close")


@query("price_validity", """SELECT * FROM (SELECT symbol, timestamp, CASE WHEN open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 THEN 'NON_POSITIVE_PRICE' WHEN high < low THEN 'HIGH_LESS_THAN_LOW'
    WHEN high < open OR high < close THEN 'HIGH_NOT_HIGHEST' WHEN low > open OR low > close THEN 'LOW_NOT_LOWEST' END AS error_type FROM dirty_bars) WHERE error_type IS NOT NULL""")
def _(t: Tables):
    return rows.price_validity(t.dirty_bars).select("symbol", "timestamp", "error_type")


@query("volume_consistency", """SELECT * FROM (SELECT symbol, timestamp, volume, CASE WHEN volume < 0 THEN 'NEGATIVE_VOLUME' WHEN up_volume < 0 OR down_volume < 0 THEN 'NEGATIVE_COMPONENT'
    WHEN up_volume + down_volume <> volume THEN 'VOLUME_MISMATCH' END AS issue FROM dirty_bars) WHERE issue IS NOT NULL""")
def _(t: Tables):
    return rows.volume_consistency(t.dirty_bars).select("symbol", "timestamp", "volume", "issue")


@query("timestamp_validity", """SELECT * FROM (SELECT symbol, timestamp, id, CASE WHEN dayofweek(timestamp) IN (0, 6) THEN 'WEEKEND' WHEN hour(timestamp) < 9 OR hour(timestamp) > 16 THEN 'NON_MARKET_HOURS' END AS issue
    FROM ticks) WHERE issue IS NOT NULL""")
def _(t: Tables):
    return rows.timestamp_validity(t.ticks).select("symbol", "timestamp", "id", "issue")


@query("zero_volume_days", "SELECT symbol, timestamp, close FROM dirty_bars WHERE volume = 0 AND interval_unit = 'daily'")
def _(t: Tables):
    return rows.zero_volume(t.dirty_bars).select("symbol", "timestamp", "close")


@query("flat_price_days", "SELECT symbol, timestamp, close, volume FROM bars WHERE open = high AND high = low AND low = close AND volume > 0")
def _(t: Tables):
    return rows.flat_price(t.bars).select("symbol", "timestamp", "close", "volume")


@query("sunday_rows", "SELECT symbol, timestamp FROM bars WHERE dayofweek(timestamp) = 0")
def _(t: Tables):
    return rows.sunday_rows(t.bars).select("symbol", "timestamp")


@query("zero_price_rows", """SELECT symbol, count(*) FILTER (close IS NULL OR close = 0) AS zero_rows, min(timestamp) FILTER (close IS NULL OR close = 0) AS first_zero,
    max(timestamp) FILTER (close IS NULL OR close = 0) AS last_zero, round(count(*) FILTER (close IS NULL OR close = 0) * 100.0 / count(*), 6)::DOUBLE AS zero_pct FROM dirty_bars GROUP BY symbol HAVING zero_rows > 0""")
def _(t: Tables):
    return rows.zero_prices(t.dirty_bars)


_PLACED = "SELECT symbol, timestamp, open, high, low, close, volume, CASE WHEN dayofyear(timestamp) % 5 = 0 OR symbol = 'Brand#3' THEN 'Placeholder' ELSE source END AS source FROM bars"


@query("placeholder_rows", f"SELECT symbol, timestamp, source FROM (SELECT *, count(*) FILTER (source <> 'Placeholder') OVER (PARTITION BY symbol) AS others FROM ({_PLACED})) WHERE source <> 'Placeholder' OR others = 0")
def _(t: Tables):
    placed = t.bars.withColumn("source", F.when((F.dayofyear("timestamp") % 5 == 0) | (F.col("symbol") == "Brand#3"), "Placeholder").otherwise(F.col("source")))
    return rows.drop_placeholders(placed).select("symbol", "timestamp", "source")


@query("session_markers", """SELECT id, strftime(timestamp, '%H:%M') >= '09:30' AND strftime(timestamp, '%H:%M') < '16:00' AS trading_hour, strftime(timestamp, '%H:%M') < '09:30' AS pre_market,
    strftime(timestamp, '%H:%M') >= '16:00' AS post_market, strftime(timestamp, '%H:%M') >= '09:30' AND strftime(timestamp, '%H:%M') < '15:30' AS can_enter FROM ticks""")
def _(t: Tables):
    return rows.session_markers(t.ticks).select("id", "trading_hour", "pre_market", "post_market", "can_enter")


@query("analysis_period", "SELECT id, rank <= 10 AS is_trading_period FROM (SELECT id, dense_rank() OVER (PARTITION BY symbol ORDER BY CAST(timestamp AS DATE) DESC) AS rank FROM ticks) WHERE rank <= 13")
def _(t: Tables):
    return rows.analysis_period(t.ticks).select("id", "is_trading_period")


@query("price_movement", f"""SELECT symbol, timestamp, open, high, low, close, round((high - low) * 100.0 / nullif(low, 0), 6) AS range_pct, round((close - open) * 100.0 / nullif(open, 0), 6) AS return_pct,
    CASE WHEN close > open THEN 'UP' WHEN close < open THEN 'DOWN' ELSE 'FLAT' END AS direction FROM bars WHERE {RECENT}""")
def _(t: Tables):
    return rows.price_movement(t.bars)


@query("volume_direction", f"""SELECT symbol, timestamp, volume, up_volume, down_volume, CASE WHEN up_volume > down_volume THEN 'UP' WHEN up_volume < down_volume THEN 'DOWN' ELSE 'NEUTRAL' END AS direction,
    round((up_volume - down_volume) * 100.0::DOUBLE / nullif(volume, 0), 6) AS imbalance_pct FROM bars WHERE {RECENT}""")
def _(t: Tables):
    return rows.volume_analysis(t.bars)


@query("valid_trading_days", """SELECT date, strftime(date, '%a') AS weekday, count(*) OVER (PARTITION BY year(date)) AS days_in_year FROM (SELECT CAST(timestamp AS DATE) AS date,
    max(close) FILTER (symbol = 'Brand#1') AS a, max(close) FILTER (symbol = 'Brand#2') AS b FROM bars GROUP BY 1) WHERE a IS NOT NULL AND b IS NOT NULL AND dayofweek(date) NOT IN (0, 6)""")
def _(t: Tables):
    wide = t.bars.groupBy(F.to_date("timestamp").alias("date")).pivot("symbol", ["Brand#1", "Brand#2"]).agg(F.max("close"))
    return rows.valid_days(wide, ["Brand#1", "Brand#2"])


@query("changed_rows", "SELECT symbol, timestamp, quality FROM bars WHERE quality < 100 ORDER BY timestamp DESC, symbol LIMIT 20")
def _(t: Tables):
    return rows.changed_rows(t.bars).select("symbol", "timestamp", "quality")


@query("below_quality", "SELECT symbol, timestamp, quality FROM bars WHERE quality < 100 ORDER BY quality, timestamp, symbol LIMIT 20")
def _(t: Tables):
    return rows.below_quality(t.bars).select("symbol", "timestamp", "quality")


@query("time_range_rows", "SELECT symbol, timestamp, close, id FROM ticks WHERE timestamp BETWEEN '2024-01-10 09:30:00' AND '2024-01-12 16:00:00'")
def _(t: Tables):
    return rows.rows_between(t.ticks, "2024-01-10 09:30:00", "2024-01-12 16:00:00").select("symbol", "timestamp", "close", "id")


@query("drop_weekends", "SELECT symbol, timestamp, close FROM bars WHERE dayofweek(timestamp) NOT IN (0, 6)")
def _(t: Tables):
    return rows.drop_weekends(t.bars).select("symbol", "timestamp", "close")


@query("latest_row_rank", "SELECT symbol, timestamp, close FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) = 1")
def _(t: Tables):
    return rows.latest_row(t.bars, ["symbol"], ["timestamp"]).select("symbol", "timestamp", "close")


@query("top_n_per_group", "SELECT symbol, timestamp, volume FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY volume DESC, timestamp) <= 10")
def _(t: Tables):
    return rows.top_n_per_group(t.bars, ["symbol"], [F.col("volume").desc(), "timestamp"], 10).select("symbol", "timestamp", "volume")


@query("order_limit", "SELECT symbol, timestamp, close FROM bars ORDER BY abs(close - open) DESC, symbol, timestamp LIMIT 50")
def _(t: Tables):
    return t.bars.orderBy(F.abs(F.col("close") - F.col("open")).desc(), "symbol", "timestamp").limit(50).select("symbol", "timestamp", "close")


@query("union_all", "SELECT symbol, timestamp, close FROM bars UNION ALL SELECT symbol, timestamp, close FROM ticks")
def _(t: Tables):
    return t.bars.select("symbol", "timestamp", "close").unionByName(t.ticks.select("symbol", "timestamp", "close"))


_DATES = "SELECT CAST(timestamp AS DATE) AS date FROM bars WHERE symbol = "


def _dates(t: Tables, symbol: str):
    return t.bars.where(F.col("symbol") == symbol).select(F.to_date("timestamp").alias("date"))


@query("date_difference", f"{_DATES} 'Brand#1' EXCEPT {_DATES} 'Brand#2'")
def _(t: Tables):
    return _dates(t, "Brand#1").subtract(_dates(t, "Brand#2"))


@query("date_intersection", f"{_DATES} 'Brand#1' INTERSECT {_DATES} 'Brand#2'")
def _(t: Tables):
    return _dates(t, "Brand#1").intersect(_dates(t, "Brand#2"))


@query("concat_sources", "SELECT symbol, 'bars' AS origin FROM bars GROUP BY symbol UNION ALL SELECT symbol, 'ticks' AS origin FROM ticks GROUP BY symbol UNION ALL SELECT symbol, 'contracts' AS origin FROM contract_bars GROUP BY symbol")
def _(t: Tables):
    named = {"bars": t.bars, "ticks": t.ticks, "contracts": t.contract_bars}
    out = [rows.symbol_list(df).withColumn("origin", F.lit(name)) for name, df in named.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("union_padded", "SELECT symbol, timestamp, close, quality, 0::BIGINT AS open_interest FROM bars UNION ALL SELECT symbol, timestamp, close, 100 AS quality, open_interest FROM contract_bars")
def _(t: Tables):
    a, b = t.bars.select("symbol", "timestamp", "close", "quality"), t.contract_bars.select("symbol", "timestamp", "close", "open_interest")
    return a.unionByName(b, allowMissingColumns=True).withColumns({"quality": F.coalesce("quality", F.lit(100)), "open_interest": F.coalesce("open_interest", F.lit(0).cast("long"))})
