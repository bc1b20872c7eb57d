"""Queries: cleaning and repair, and mutations of tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebar.operators import cleaning as c
from tidebar.plans.register import query
from tidebar.sources.adapters import Tables

BY = "OVER (PARTITION BY symbol ORDER BY timestamp)"
BACK = "OVER (PARTITION BY symbol ORDER BY timestamp ROWS UNBOUNDED PRECEDING)"
AHEAD = "OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
KEYS = ("symbol", "timestamp")


def pick(df, *columns):
    return df.select(*KEYS, *columns)


@query("fix_ohlc", "SELECT symbol, timestamp, greatest(open, high, low, close) AS high, least(open, high, low, close) AS low FROM dirty_bars")
def _(t: Tables):
    return pick(c.fix_ohlc(t.dirty_bars), "high", "low")


@query("swap_high_low", "SELECT symbol, timestamp, CASE WHEN high < low THEN low ELSE high END AS high, CASE WHEN high < low THEN high ELSE low END AS low FROM dirty_bars")
def _(t: Tables):
    return pick(c.swap_high_low(t.dirty_bars), "high", "low")


@query("fill_by_reference_ratio", """WITH a AS (SELECT timestamp::DATE AS date, max(close) AS value FROM bars WHERE symbol = 'Brand#1' GROUP BY 1), b AS (SELECT timestamp::DATE AS date, max(close) AS value FROM bars WHERE symbol = 'Brand#2' GROUP BY 1),
    j AS (SELECT coalesce(a.date, b.date) AS date, a.value AS own, b.value AS ref FROM a FULL JOIN b ON a.date = b.date), x AS (SELECT avg(own / ref) AS ratio FROM (SELECT * FROM j WHERE own IS NOT NULL AND ref IS NOT NULL AND ref <> 0 ORDER BY date LIMIT 10))
    SELECT date, round(CASE WHEN own IS NULL THEN ref * ratio ELSE own END, 6) AS value, CASE WHEN own IS NULL THEN 80 ELSE 100 END AS quality FROM j, x WHERE own IS NOT NULL OR ref * ratio IS NOT NULL""")
def _(t: Tables):
    of = lambda s: t.bars.where(F.col("symbol") == s).groupBy(F.to_date("timestamp").alias("date")).agg(F.max("close").alias("value"))
    return c.fill_by_ratio(of("Brand#1"), of("Brand#2"), 10).withColumn("value", F.round("value", 6))


_FILL = {
    "z_map": "SELECT root, date, position, symbol FROM (SELECT d.root, d.date, CAST(row_number() OVER (PARTITION BY d.root, d.date ORDER BY k.last_date, k.symbol) AS INT) AS position, k.symbol FROM (SELECT DISTINCT root, timestamp::DATE AS date FROM contract_bars) d JOIN contracts k ON k.root = d.root AND k.last_date >= d.date) WHERE position <= 3",
    "z_raw": "SELECT m.root, m.date, m.position, CASE WHEN dayofyear(m.date) % 13 = 0 OR day(m.date) = 4 THEN 0.0 ELSE coalesce(b.close, 0.0) END AS raw FROM z_map m LEFT JOIN contract_bars b ON b.symbol = m.symbol AND b.timestamp = m.date",
    "z_index": "SELECT root, timestamp::DATE AS date, nullif(CASE WHEN dayofyear(timestamp) % 7 = 0 OR day(timestamp) = 4 THEN 0.0 ELSE max(close) END, 0.0) AS iv FROM contract_bars GROUP BY root, timestamp",
    "z_known": "SELECT r.*, CASE WHEN raw > 0 THEN raw END AS v, epoch_us(r.date::TIMESTAMP)::DOUBLE AS x, row_number() OVER (PARTITION BY r.root, position ORDER BY r.date) AS n, iv, max(CASE WHEN position = 1 AND raw > 0 THEN raw END) OVER (PARTITION BY r.root, r.date) AS front FROM z_raw r LEFT JOIN z_index i ON i.root = r.root AND i.date = r.date",
    "z_lined": "SELECT *, last_value(CASE WHEN v IS NOT NULL THEN n END IGNORE NULLS) OVER b AS n0, last_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER b AS x0, last_value(v IGNORE NULLS) OVER b AS y0, first_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER a AS x1, first_value(v IGNORE NULLS) OVER a AS y1, row_number() OVER (PARTITION BY root, position, v IS NOT NULL AND front IS NOT NULL ORDER BY date DESC) AS nf, row_number() OVER (PARTITION BY root, position, v IS NOT NULL AND iv IS NOT NULL ORDER BY date DESC) AS ni FROM z_known WINDOW b AS (PARTITION BY root, position ORDER BY date ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY root, position ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
    "z_ratios": "SELECT root, position, CASE WHEN count(*) FILTER (v IS NOT NULL AND front IS NOT NULL) >= 10 THEN avg(v / front) FILTER (v IS NOT NULL AND front IS NOT NULL AND nf <= 60) END AS rf, CASE WHEN count(*) FILTER (v IS NOT NULL AND iv IS NOT NULL) >= 10 THEN avg(v / iv) FILTER (v IS NOT NULL AND iv IS NOT NULL AND ni <= 60) END AS ri FROM z_lined GROUP BY root, position",
    "z_ways": "SELECT l.*, CASE WHEN l.date NOT IN (SELECT date FROM z_known WHERE v IS NOT NULL OR iv IS NOT NULL) THEN raw END AS w_holiday, CASE WHEN y1 IS NOT NULL AND n - n0 <= 5 THEN y0 + (y1 - y0) * (x - x0) / nullif(x1 - x0, 0) END AS w_line, CASE WHEN l.position > 1 THEN front * rf END AS w_ratio, CASE WHEN l.position > 1 THEN front * (1 + (l.position - 1) * 0.03::DOUBLE) END AS w_place, iv * ri AS w_ri, iv * (1.1::DOUBLE + (l.position - 1) * 0.05::DOUBLE) AS w_index FROM z_lined l JOIN z_ratios q ON q.root = l.root AND q.position = l.position",
}


@query("fill_zero_prices", """SELECT root, position, date, round(coalesce(v, w_holiday, w_line, w_ratio, w_place, w_ri, w_index), 6) AS value, CASE WHEN v IS NOT NULL THEN 'original' WHEN w_holiday IS NOT NULL THEN 'holiday' WHEN w_line IS NOT NULL THEN 'interpolated' WHEN w_ratio IS NOT NULL THEN 'ratio' WHEN w_place IS NOT NULL THEN 'position' WHEN w_ri IS NOT NULL THEN 'index_ratio' WHEN w_index IS NOT NULL THEN 'index' END AS method,
    CASE WHEN v IS NOT NULL OR w_holiday IS NOT NULL THEN 100 WHEN w_line IS NOT NULL THEN 80 WHEN coalesce(w_ratio, w_place, w_ri, w_index) IS NOT NULL THEN 75 END AS quality FROM z_ways""", _FILL)
def _(t: Tables):
    from tidebar.operators.continuous import continuous_nth
    from tidebar.operators.rolls import continuous_mapping

    dates = t.contract_bars.select("root", F.to_date("timestamp").alias("date")).distinct()
    nth = continuous_nth(t.contract_bars, continuous_mapping(dates, t.contracts, 3))
    closed = lambda date, n: (F.dayofyear(date) % n == 0) | (F.dayofmonth(date) == 4)
    series = nth.select("root", "position", "date", F.when(closed("date", 13), 0.0).otherwise(F.coalesce("close", F.lit(0.0))).alias("value"))
    index = t.contract_bars.groupBy("root", F.to_date("timestamp").alias("date")).agg(F.max("close").alias("value"))
    return c.fill_zero_prices(series, index.withColumn("value", F.when(closed("date", 7), 0.0).otherwise(F.col("value"))))


_LINE = f"""CASE WHEN x1 IS NULL THEN y0 ELSE y0 + (y1 - y0) * (n - x0) / nullif(x1 - x0, 0) END"""
_LINED = f"""SELECT *, last_value(CASE WHEN v IS NOT NULL THEN n END IGNORE NULLS) {BACK} AS x0, first_value(CASE WHEN v IS NOT NULL THEN n END IGNORE NULLS) {AHEAD} AS x1, last_value(v IGNORE NULLS) {BACK} AS y0, first_value(v IGNORE NULLS) {AHEAD} AS y1 FROM"""


@query("interpolate_linear", f"SELECT symbol, timestamp, round(coalesce(v, {_LINE}), 6) AS open FROM ({_LINED} (SELECT symbol, timestamp, open AS v, row_number() {BY}::DOUBLE AS n FROM dirty_bars))")
def _(t: Tables):
    return pick(c.interpolate(t.dirty_bars, ["open"]), F.round("open", 6).alias("open"))


@query("interpolate_time", f"SELECT symbol, timestamp, round(coalesce(v, {_LINE}), 6) AS open FROM ({_LINED} (SELECT symbol, timestamp, open AS v, epoch_us(timestamp)::DOUBLE AS n FROM dirty_bars))")
def _(t: Tables):
    return pick(c.interpolate(t.dirty_bars, ["open"], by="time"), F.round("open", 6).alias("open"))


@query("zero_price_interpolate", f"""SELECT symbol, timestamp, round(CASE WHEN v IS NOT NULL THEN w WHEN share >= 0.5 AND {_LINE} > 0 THEN {_LINE} ELSE w END, 6) AS close FROM ({_LINED} (SELECT symbol, timestamp, close AS w, CASE WHEN abs(close) >= 1e-6 THEN close END AS v,
    row_number() {BY}::DOUBLE AS n, avg(CASE WHEN abs(close) >= 1e-6 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY symbol) AS share FROM dirty_bars))""")
def _(t: Tables):
    return pick(c.interpolate_zero(t.dirty_bars, ["close"]), F.round("close", 6).alias("close"))


_NEAR = "list_concat(coalesce(list(v) FILTER (v > 0) OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), []), coalesce(list(v) FILTER (v > 0) OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), []))"


@query("estimate_volume", f"SELECT symbol, timestamp, CASE WHEN v IS NULL OR v = 0 THEN coalesce(CASE WHEN len(near) >= 5 THEN CAST(round(list_median(near), -2) AS BIGINT) END, v) ELSE v END AS volume FROM (SELECT symbol, timestamp, v, {_NEAR} AS near FROM (SELECT *, volume AS v FROM dirty_bars))")
def _(t: Tables):
    return pick(c.estimate_volume(t.dirty_bars), "volume")


@query("estimate_open_interest", f"""SELECT symbol, timestamp, CASE WHEN v IS NULL OR v = 0 THEN coalesce(CASE WHEN p > 0 THEN p END, CASE WHEN x > 0 THEN x END, CASE WHEN len(near) >= 5 THEN CAST(round(list_median(near), -2) AS BIGINT) END, v) ELSE v END AS open_interest
    FROM (SELECT symbol, timestamp, v, lag(v) {BY} AS p, lead(v) {BY} AS x, {_NEAR} AS near FROM (SELECT *, volume AS v FROM dirty_bars))""")
def _(t: Tables):
    return pick(c.estimate_open_interest(t.dirty_bars.withColumn("open_interest", F.col("volume"))), "open_interest")


@query("rescale_by_median", """WITH s AS (SELECT symbol, timestamp, CASE WHEN symbol IN ('Brand#1', 'Brand#2') THEN open / 1e5 ELSE open END AS open, CASE WHEN symbol IN ('Brand#1', 'Brand#2') THEN high / 1e5 ELSE high END AS high, CASE WHEN symbol IN ('Brand#1', 'Brand#2') THEN low / 1e5 ELSE low END AS low,
    CASE WHEN symbol IN ('Brand#1', 'Brand#2') THEN close / 1e5 ELSE close END AS close FROM bars), m AS (SELECT symbol, list_median([median(open), median(high), median(low), median(close)]) AS m FROM s GROUP BY symbol) SELECT symbol, timestamp, round(CASE WHEN m < 1 THEN close * 1000 ELSE close END, 6) AS close FROM s JOIN m USING (symbol)""")
def _(t: Tables):
    small = t.bars.withColumns({x: F.when(F.col("symbol").isin("Brand#1", "Brand#2"), F.col(x) / 1e5).otherwise(F.col(x)) for x in c.OHLC})
    return pick(c.rescale_by_median(small), F.round("close", 6).alias("close"))


@query("close_settle_crossfill", "SELECT symbol, timestamp, coalesce(a, b) AS close, coalesce(b, a) AS settle FROM (SELECT *, nullif(close, 0) AS a, open AS b FROM dirty_bars)")
def _(t: Tables):
    return pick(c.crossfill(t.dirty_bars.withColumns({"close": F.nullif("close", F.lit(0.0)), "settle": F.col("open")})), "close", "settle")


_BAND = "(PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING)"


@query("cap_outliers", f"SELECT symbol, timestamp, {', '.join(f'round(CASE WHEN {x} IS NOT NULL AND stddev_samp({x}) OVER w IS NOT NULL THEN least(greatest({x}, avg({x}) OVER w - 4 * stddev_samp({x}) OVER w), avg({x}) OVER w + 4 * stddev_samp({x}) OVER w) ELSE {x} END, 6) AS {x}' for x in ('high', 'close'))} FROM dirty_bars WINDOW w AS {_BAND}")
def _(t: Tables):
    return pick(c.cap_outliers(t.dirty_bars, columns=("high", "close")), F.round("high", 6).alias("high"), F.round("close", 6).alias("close"))


@query("fill_missing_ohlc", f"SELECT symbol, timestamp, coalesce(open, close, m) AS open, coalesce(close, open, m) AS close, coalesce(high, greatest(open, close), m) AS high FROM (SELECT symbol, timestamp, open, high, close, (lag(close) {BY} + lead(open) {BY}) / 2 AS m FROM dirty_bars)")
def _(t: Tables):
    return pick(c.fill_missing_ohlc(t.dirty_bars), "open", "close", "high")


@query("clamp_open_close", "SELECT symbol, timestamp, CASE WHEN open IS NOT NULL THEN least(greatest(open, low), high) END AS open, least(greatest(close, low), high) AS close FROM dirty_bars")
def _(t: Tables):
    return pick(c.clamp_into_range(t.dirty_bars), "open", "close")


@query("price_spike", "SELECT symbol, timestamp, round(CASE WHEN abs(high - m) * 100.0 / nullif(m, 0) > 50 THEN m ELSE high END, 6) AS high FROM (SELECT *, avg(high) OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS m FROM dirty_bars)")
def _(t: Tables):
    return pick(c.price_spike(t.dirty_bars, column="high"), F.round("high", 6).alias("high"))


@query("minimum_value", "SELECT symbol, timestamp, greatest(close, 10.0) AS close FROM dirty_bars")
def _(t: Tables):
    return pick(c.minimum_value(t.dirty_bars, ["close"], 10.0), "close")


@query("negative_to_zero", "SELECT symbol, timestamp, CASE WHEN v < 0 THEN 0 ELSE v END AS volume FROM (SELECT *, volume - 20 AS v FROM dirty_bars)")
def _(t: Tables):
    return pick(c.fix_negative(t.dirty_bars.withColumn("volume", F.col("volume") - 20), ["volume"]), "volume")


@query("missing_volume_rolling", "SELECT symbol, timestamp, coalesce(v, CAST(round(avg(v) OVER (PARTITION BY symbol ORDER BY timestamp ROWS 4 PRECEDING)) AS BIGINT)) AS volume FROM (SELECT *, nullif(volume, 0) AS v FROM dirty_bars)")
def _(t: Tables):
    return pick(c.fill_volume(t.dirty_bars.withColumn("volume", F.nullif("volume", F.lit(0).cast("long")))), "volume")


@query("after_hours_copy_previous", f"SELECT symbol, timestamp, CASE WHEN open IS NULL AND day(timestamp) > 15 THEN last_value(open IGNORE NULLS) {BACK} ELSE open END AS open FROM dirty_bars")
def _(t: Tables):
    return pick(c.copy_previous(t.dirty_bars, F.dayofmonth("timestamp") > 15, "open"), "open")


@query("price_gap_flag", f"SELECT symbol, timestamp, coalesce(abs((close - lag(close) {BY}) / nullif(lag(close) {BY}, 0)) * 100 > 5, false) AS price_gap FROM dirty_bars")
def _(t: Tables):
    return pick(c.flag_gap(t.dirty_bars), "price_gap")


@query("drop_return_outliers", f"""SELECT symbol, timestamp, close FROM (SELECT symbol, timestamp, close, r, CASE WHEN count(r) OVER w >= 5 THEN stddev_samp(r) OVER w END AS s FROM (SELECT *, close / nullif(lag(close) {BY}, 0) - 1 AS r FROM bars) WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS 19 PRECEDING)) WHERE NOT coalesce(abs(r) > 3 * s, false)""")
def _(t: Tables):
    return pick(c.drop_return_outliers(t.bars, 3.0), "close")


@query("dedupe_best_row", "SELECT symbol, d AS timestamp, id, close FROM (SELECT symbol, date_trunc('day', timestamp) AS d, id, CASE WHEN id % 3 = 0 THEN NULL ELSE close END AS close FROM user_ticks) QUALIFY row_number() OVER (PARTITION BY symbol, d ORDER BY CASE WHEN close IS NULL THEN 1 ELSE 0 END, id) = 1")
def _(t: Tables):
    daily = t.user_ticks.select("symbol", F.date_trunc("day", "timestamp").alias("timestamp"), "id", F.when(F.col("id") % 3 != 0, F.col("close")).alias("close"))
    return c.dedupe_best(daily, values=("close",))


@query("quality_score_row", """SELECT symbol, timestamp, greatest(100 - 20 * ((open IS NULL)::INT + (high IS NULL)::INT + (low IS NULL)::INT + (close IS NULL)::INT) - 15 * coalesce(high < open OR high < close, false)::INT - 15 * coalesce(low > open OR low > close, false)::INT - 25 * coalesce(high < low, false)::INT, 0) AS quality_score FROM dirty_bars""")
def _(t: Tables):
    return pick(c.quality_score(t.dirty_bars), "quality_score")


@query("fix_contract_expiration", "SELECT b.symbol, b.timestamp, k.expiry_month + 14 AS expiry FROM contract_bars b JOIN contracts k ON b.symbol = k.symbol WHERE b.timestamp::DATE > k.expiry_month + 14")
def _(t: Tables):
    expiries = t.contracts.select("symbol", F.date_add("expiry_month", 14).alias("expiry"))
    return c.after_expiry(t.contract_bars, expiries).select("symbol", "timestamp", "expiry")


_PIPE = ("swap_high_low", "fix_ohlc")
_STEPS = """WITH a AS (SELECT *, CASE WHEN high < low THEN low ELSE high END AS h1, CASE WHEN high < low THEN high ELSE low END AS l1 FROM dirty_bars), b AS (SELECT *, greatest(open, h1, l1, close) AS h2, least(open, h1, l1, close) AS l2 FROM a)"""
_LOG = """SELECT symbol, timestamp, 'swap_high_low' AS rule, 'high' AS field, high AS old_value, h1 AS new_value FROM b WHERE high IS DISTINCT FROM h1 UNION ALL SELECT symbol, timestamp, 'swap_high_low', 'low', low, l1 FROM b WHERE low IS DISTINCT FROM l1
    UNION ALL SELECT symbol, timestamp, 'fix_ohlc', 'high', h1, h2 FROM b WHERE h1 IS DISTINCT FROM h2 UNION ALL SELECT symbol, timestamp, 'fix_ohlc', 'low', l1, l2 FROM b WHERE l1 IS DISTINCT FROM l2"""


@query("cleaning_pipeline", f"{_STEPS} SELECT symbol, timestamp, open, h2 AS high, l2 AS low, close FROM b")
def _(t: Tables):
    return pick(c.run_pipeline(t.dirty_bars, [c.RULES[n] for n in _PIPE])[0], *c.OHLC)


@query("cleaning_log", f"{_STEPS} {_LOG}")
def _(t: Tables):
    return c.run_pipeline(t.dirty_bars, [c.RULES[n] for n in _PIPE])[1]


@query("cleaning_summary", f"{_STEPS} SELECT rule, field, count(*) AS changes FROM ({' '.join(_LOG.split())}) GROUP BY rule, field")
def _(t: Tables):
    return c.run_pipeline(t.dirty_bars, [c.RULES[n] for n in _PIPE])[2]


@query("auto_fix", f"{_STEPS} SELECT rule, field, count(*) AS changes FROM ({' '.join(_LOG.split())}) GROUP BY rule, field")
def _(t: Tables):
    return c.auto_fix(t.dirty_bars, _PIPE)[1]


@query("cleaner_registry", f"{_STEPS} SELECT symbol, timestamp, h2 AS high, l2 AS low FROM b")
def _(t: Tables):
    chosen = sorted((rule for rule in c.RULES.values() if set(rule.columns) == {"high", "low"}), key=lambda rule: rule.priority)
    return pick(c.run_pipeline(t.dirty_bars, chosen)[0], "high", "low")
