"""Queries: validation, quality metrics and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebar.operators import quality as k
from tidebar.plans.register import query
from tidebar.sources.adapters import Tables

BY = "OVER (PARTITION BY symbol ORDER BY timestamp)"
BAD = "(high < open OR high < close OR high < low OR low > open OR low > close)"
PRICES = ("open", "high", "low", "close")


def _z(column: str, z: float) -> str:
    return f"SELECT * FROM (SELECT symbol, timestamp, round(({column} - avg({column}) OVER w) / nullif(stddev_samp({column}) OVER w, 0), 6) AS zscore FROM dirty_bars WINDOW w AS (PARTITION BY symbol)) WHERE abs(zscore) > {z}"


@query("price_zscore_outliers", _z("close", 1.5))
def _(t: Tables):
    return k.zscore_outliers(t.dirty_bars, "close", 1.5).select("symbol", "timestamp", "zscore")


@query("volume_zscore_outliers", _z("volume", 3))
def _(t: Tables):
    return k.zscore_outliers(t.dirty_bars, "volume").select("symbol", "timestamp", "zscore")


_QUALITY = "round(avg(quality), 6) AS avg_quality, min(quality) AS min_quality, max(quality) AS max_quality, count(*) FILTER (quality < 90) AS low_count, round(count(*) FILTER (quality < 90) * 100.0::DOUBLE / count(*), 6) AS low_pct FROM bars GROUP BY"


@query("quality_by_symbol", f"SELECT symbol, {_QUALITY} symbol")
def _(t: Tables):
    return k.quality_by(t.bars, "symbol")


@query("quality_by_source", f"SELECT source, {_QUALITY} source")
def _(t: Tables):
    return k.quality_by(t.bars, "source")


@query("missing_fields", "SELECT * FROM (SELECT symbol, " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS missing_{c}" for c in (*PRICES, "volume")) + " FROM dirty_bars GROUP BY symbol) WHERE missing_open + missing_high + missing_low + missing_close + missing_volume > 0")
def _(t: Tables):
    return k.missing_fields(t.dirty_bars)


@query("worst_symbols", f"SELECT symbol, round(count(*) FILTER (coalesce({BAD}, false) OR quality < 90 OR close IS NULL OR coalesce(volume, 0) = 0) * 100.0::DOUBLE / count(*), 6) AS issue_pct, count(*) AS n FROM dirty_bars GROUP BY symbol ORDER BY issue_pct DESC, symbol LIMIT 10")
def _(t: Tables):
    return k.worst_symbols(t.dirty_bars)


@query("completeness_check", "SELECT symbol, count(*) AS days, count(*) FILTER (n > 1) AS duplicate_days FROM (SELECT symbol, timestamp::DATE AS d, count(*) AS n FROM user_ticks GROUP BY 1, 2) GROUP BY symbol")
def _(t: Tables):
    return k.completeness_check(t.user_ticks)


@query("quality_score_symbol", f"""SELECT symbol, round(100 - 30 * avg((quality < 90)::INT) - 30 * avg((open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL)::INT) - 20 * avg((volume IS NULL)::INT) - 20 * avg(coalesce({BAD}, false)::INT), 6) AS score FROM dirty_bars GROUP BY symbol""")
def _(t: Tables):
    return k.quality_score_symbol(t.dirty_bars)


@query("source_consistency", "SELECT * FROM (SELECT symbol, timestamp::DATE AS date, 'feed' AS source, round(avg(close), 6) AS avg_close, round(stddev_samp(close), 6) AS std_close FROM user_ticks GROUP BY 1, 2) WHERE std_close > 0.01")
def _(t: Tables):
    return k.source_consistency(t.user_ticks.withColumn("source", F.lit("feed")))


@query("freshness", """SELECT symbol, max(timestamp) AS last, count(*) FILTER (date_diff('day', timestamp, m) <= 1) AS last_day, count(*) FILTER (date_diff('day', timestamp, m) <= 7) AS last_week, CASE WHEN min(date_diff('day', timestamp, m)) <= 1 THEN 'CURRENT' WHEN min(date_diff('day', timestamp, m)) <= 7 THEN 'RECENT' ELSE 'STALE' END AS status
    FROM bars, (SELECT max(timestamp) AS m FROM bars) GROUP BY symbol""")
def _(t: Tables):
    return k.freshness(t.bars)


@query("symbol_consistency", "SELECT symbol, count(DISTINCT interval_unit) AS units, count(DISTINCT source) AS sources FROM bars GROUP BY symbol HAVING units > 1 OR sources > 1")
def _(t: Tables):
    return k.symbol_consistency(t.bars)


@query("completeness_report", "SELECT symbol, count(*) AS n, count(DISTINCT timestamp::DATE) AS trading_days, round(count(*) FILTER (close IS NULL OR open IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_pct, round(count(*) FILTER (quality < 90) * 100.0::DOUBLE / count(*), 6) AS low_quality_pct FROM dirty_bars GROUP BY symbol")
def _(t: Tables):
    return k.completeness_report(t.dirty_bars)


#: Prices in whole cents and the day as text, so that a record is written alike by all engines.
_CENTS = "SELECT symbol, strftime(timestamp, '%Y-%m-%d') AS day, " + ", ".join(f"CAST(round({c} * 100) AS BIGINT) AS {c}" for c in PRICES) + ", volume FROM dirty_bars"
_RECORD = "'{' || concat_ws(',', " + ", ".join([f"""'"{c}":"' || {c} || '"'""" for c in ("symbol", "day")] + [f"""'"{c}":' || {c}""" for c in (*PRICES, "volume")]) + ") || '}'"
_FAILURES = " UNION ALL ".join(f"SELECT symbol, day, '{name}' AS rule, '{column}' AS field, {_RECORD} AS record FROM cents WHERE NOT ({cond})" for name, (cond, column) in k.BAR_RULES.items())


@query("rule_validation", _FAILURES, {"cents": _CENTS})
def _(t: Tables):
    cents = t.dirty_bars.select("symbol", F.date_format("timestamp", "yyyy-MM-dd").alias("day"), *(F.round(F.col(c) * 100).cast("long").alias(c) for c in PRICES), "volume")
    return k.validate(cents, k.BAR_RULES, ["symbol", "day"])


@query("validation_batch", "SELECT count(*) AS n, " + ", ".join(f"count(*) FILTER (NOT ({cond})) AS failed_{name}" for name, (cond, _) in k.BAR_RULES.items()) + " FROM dirty_bars")
def _(t: Tables):
    return k.validation_batch(t.dirty_bars, k.BAR_RULES)


_BROKEN = " OR ".join(f"coalesce(NOT ({cond}), false)" for cond, _ in k.BAR_RULES.values())


@query("validation_metrics", f"SELECT CAST(sum(n) AS BIGINT) AS n, round(avg(cv), 6) AS avg_price_cv, round(100 - sum(bad) * 100.0::DOUBLE / sum(n), 6) AS overall_score, {', '.join(f'round(sum(h_{c}) * 100.0::DOUBLE / sum(n), 6) AS complete_{c}' for c in (*PRICES, 'volume'))} FROM (SELECT symbol, count(*) AS n, count(*) FILTER ({_BROKEN}) AS bad, stddev_samp(close) / nullif(avg(close), 0) AS cv, {', '.join(f'count({c}) AS h_{c}' for c in (*PRICES, 'volume'))} FROM dirty_bars GROUP BY symbol)")
def _(t: Tables):
    return k.validation_metrics(t.dirty_bars, k.BAR_RULES)


@query("price_checks", f"SELECT symbol, count(*) FILTER ({BAD}) AS ohlc_errors, count(*) FILTER (least(open, high, low, close) = 0) AS zero_rows, count(*) FILTER ((high - low) / nullif(low, 0) > 0.5) AS extreme_rows, {', '.join(f'{f}({c}) AS {f}_{c}' for c in PRICES for f in ('min', 'max'))} FROM dirty_bars GROUP BY symbol")
def _(t: Tables):
    return k.price_checks(t.dirty_bars)


@query("volume_checks", "SELECT symbol, count(*) FILTER (volume = 0) AS zero_days, count(*) FILTER (abs(z) > 3) AS spikes, round(avg(volume), 6) AS avg_volume, max(volume) AS max_volume FROM (SELECT *, (volume - avg(volume) OVER w) / nullif(stddev_samp(volume) OVER w, 0) AS z FROM dirty_bars WINDOW w AS (PARTITION BY symbol)) GROUP BY symbol")
def _(t: Tables):
    return k.volume_checks(t.dirty_bars)


_STAT = f"SELECT symbol, close / nullif(lag(close) {BY}, 0) - 1 AS ret, (high - low) / nullif(close, 0) AS range, open / nullif(lag(close) {BY}, 0) - 1 AS gap FROM dirty_bars"


@query("statistical_checks", f"SELECT symbol, {', '.join(f'count(*) FILTER (abs(z_{c}) > 3) AS {c}_outliers, round(avg({c}), 6) AS avg_{c}' for c in ('ret', 'range', 'gap'))} FROM (SELECT *, {', '.join(f'({c} - avg({c}) OVER w) / nullif(stddev_samp({c}) OVER w, 0) AS z_{c}' for c in ('ret', 'range', 'gap'))} FROM ({_STAT}) WINDOW w AS (PARTITION BY symbol)) GROUP BY symbol")
def _(t: Tables):
    return k.statistical_checks(t.dirty_bars)


@query("descriptive_stats", " UNION ALL ".join(f"SELECT symbol, '{c}' AS field, count({c}) AS n, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c}), 6) AS mean, round(median({c}::DOUBLE), 6) AS median, round(stddev_samp({c}), 6) AS std, round(skewness({c}), 4) AS skew, round(kurtosis({c}), 4) AS kurtosis, count(*) FILTER ({c} = 0) AS zeros FROM bars GROUP BY symbol" for c in ("close", "volume")))
def _(t: Tables):
    return k.descriptive_stats(t.bars)


@query("missing_summary", " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({c} IS NULL) AS missing, round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_pct FROM dirty_bars" for c in (*PRICES, "volume")))
def _(t: Tables):
    return k.missing_summary(t.dirty_bars.select(*PRICES, "volume"))


@query("sigma_outliers", " UNION ALL ".join(f"SELECT symbol, timestamp, '{c}' AS field, {c} AS value FROM (SELECT *, avg({c}) OVER w AS m, stddev_samp({c}) OVER w AS s FROM dirty_bars WINDOW w AS (PARTITION BY symbol)) WHERE abs({c} - m) > 3 * s" for c in PRICES))
def _(t: Tables):
    return k.sigma_outliers(t.dirty_bars)


@query("extreme_returns", f"SELECT symbol, timestamp, round(ret, 6) AS ret FROM (SELECT *, avg(ret) OVER w AS m, stddev_samp(ret) OVER w AS s FROM (SELECT *, close / nullif(lag(close) {BY}, 0) - 1 AS ret FROM dirty_bars) WINDOW w AS (PARTITION BY symbol)) WHERE abs(ret - m) > 3 * s")
def _(t: Tables):
    return k.extreme_returns(t.dirty_bars)


@query("consistency_report", " UNION ALL ".join(f"SELECT '{name}' AS issue, count(*) FILTER ({cond}) AS n, round(count(*) FILTER ({cond}) * 100.0::DOUBLE / count(*), 6) AS pct FROM dirty_bars" for name, cond in k.ISSUES.items()))
def _(t: Tables):
    return k.consistency_report(t.dirty_bars)


@query("consistency_examples", "SELECT symbol, timestamp, issue FROM (" + " UNION ALL ".join(f"SELECT symbol, timestamp, '{name}' AS issue FROM dirty_bars WHERE {cond}" for name, cond in k.ISSUES.items()) + ") QUALIFY row_number() OVER (PARTITION BY issue ORDER BY timestamp, symbol) <= 10")
def _(t: Tables):
    return k.consistency_examples(t.dirty_bars)


@query("multi_method_outliers", f"""WITH s AS (SELECT symbol, avg(high) AS m, stddev_samp(high) AS sd, quantile_cont(high, 0.25) AS a, quantile_cont(high, 0.75) AS b FROM dirty_bars GROUP BY symbol), r AS (SELECT timestamp, avg(close) AS ref FROM bars GROUP BY timestamp),
    x AS (SELECT *, abs(high / nullif(lag(high) {BY}, 0) - 1) AS ch FROM dirty_bars)
    SELECT * FROM (SELECT x.symbol, x.timestamp, high AS value, array_to_string(list_filter([CASE WHEN abs((high - m) / nullif(sd, 0)) > 4 THEN 'zscore' END, CASE WHEN high < a - 3 * (b - a) OR high > b + 3 * (b - a) THEN 'iqr' END, CASE WHEN ch > 0.3 THEN 'change' END, CASE WHEN high < 1 OR high > 5000 THEN 'bounds' END,
    CASE WHEN abs(high / nullif(ref, 0) - 1) > 0.3 THEN 'reference' END], lambda v: v IS NOT NULL), ',') AS methods FROM x JOIN s ON s.symbol = x.symbol LEFT JOIN r ON r.timestamp = x.timestamp) WHERE methods <> ''""")
def _(t: Tables):
    reference = t.bars.groupBy("timestamp").agg(F.avg("close").alias("value"))
    return k.multi_method_outliers(t.dirty_bars.select("symbol", "timestamp", F.col("high").alias("value")), reference)


@query("table_profile", "SELECT 'bars' AS name, count(*) AS n, CAST(13 AS BIGINT) AS columns, CAST(count(*) * (16 * 3 + 8 * 8 + 4 * 2) AS BIGINT) AS estimated_bytes FROM bars UNION ALL SELECT 'ticks' AS name, count(*), 9, CAST(count(*) * (16 * 2 + 8 * 7) AS BIGINT) FROM ticks")
def _(t: Tables):
    return k.table_profile({"bars": t.bars, "ticks": t.ticks})
