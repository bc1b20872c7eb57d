"""Queries: joins, calendars and contract codes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidebar.functions import calendars as c
from tidebar.functions import symbols as s
from tidebar.operators import joins as j
from tidebar.plans.register import query
from tidebar.sources.adapters import MONTH_CODES, Tables

BY = "OVER (PARTITION BY symbol ORDER BY timestamp)"
HOLIDAY_LIST = ", ".join(f"DATE '{h}'" for h in c.HOLIDAYS)


@query("economic_calendar", "SELECT e.*, m.category FROM econ e LEFT JOIN econ_meta m USING (indicator)")
def _(t: Tables):
    return j.economic_calendar(t.econ, t.econ_meta)


@query("account_summary", """SELECT b.account_id, b.timestamp, b.cash, count(DISTINCT p.symbol) AS symbols, round(sum(p.market_value), 4) AS market_value, round(sum(p.unrealized_pnl), 4) AS unrealized_pnl, count(*) FILTER (p.unrealized_pnl > 0) AS winners,
    count(*) FILTER (p.unrealized_pnl < 0) AS losers FROM balances b LEFT JOIN positions p ON b.account_id = p.account_id AND b.timestamp::DATE = p.timestamp::DATE GROUP BY 1, 2, 3""")
def _(t: Tables):
    return j.account_summary(t.balances, t.positions)


@query("active_positions", "SELECT account_id, symbol, timestamp, quantity, market_value FROM positions QUALIFY row_number() OVER (PARTITION BY account_id, symbol ORDER BY timestamp DESC) = 1 AND quantity <> 0")
def _(t: Tables):
    return j.active_positions(t.positions)


@query("duplicate_detail", "SELECT symbol, timestamp, id, copies FROM (SELECT *, count(*) OVER (PARTITION BY symbol, timestamp::DATE) AS copies FROM user_ticks) WHERE copies > 1")
def _(t: Tables):
    marked = t.user_ticks.withColumns({"interval_value": F.lit(1), "interval_unit": F.lit("daily")})
    return j.duplicate_detail(marked).select("symbol", "timestamp", "id", "copies")


@query("zscore_join", "SELECT b.symbol, b.timestamp, round((b.close - m) / nullif(sd, 0), 6) AS zscore FROM bars b JOIN (SELECT symbol, avg(close) AS m, stddev_samp(close) AS sd FROM bars GROUP BY symbol) s ON b.symbol = s.symbol WHERE abs((b.close - m) / nullif(sd, 0)) > 1.5")
def _(t: Tables):
    stats = t.bars.groupBy("symbol").agg(F.avg("close").alias("m"), F.stddev_samp("close").alias("sd"))
    z = F.try_divide(F.col("close") - F.col("m"), F.col("sd"))
    return t.bars.join(stats, "symbol").where(F.abs(z) > 1.5).select("symbol", "timestamp", F.round(z, 6).alias("zscore"))


@query("pair_correlation", f"""WITH x AS (SELECT * FROM (SELECT symbol, timestamp, ln(close / lag(close) {BY}) AS ret FROM bars) WHERE ret IS NOT NULL AND timestamp >= (SELECT max(timestamp) FROM bars) - INTERVAL 365 DAY)
    SELECT a.symbol, b.symbol AS other, round(corr(a.ret, b.ret), 6) AS correlation, count(*) AS n FROM x a JOIN x b ON a.timestamp = b.timestamp AND a.symbol < b.symbol GROUP BY 1, 2 HAVING count(*) > 20""")
def _(t: Tables):
    return j.pair_correlation(t.bars)


@query("period_compare", """SELECT symbol, count(*) FILTER (timestamp BETWEEN '1996-01-01' AND '1996-12-31') AS first_period, count(*) FILTER (timestamp BETWEEN '1997-01-01' AND '1997-12-31') AS second_period,
    count(*) FILTER (timestamp BETWEEN '1997-01-01' AND '1997-12-31') - count(*) FILTER (timestamp BETWEEN '1996-01-01' AND '1996-12-31') AS difference FROM bars GROUP BY symbol""")
def _(t: Tables):
    return j.period_compare(t.bars, ("1996-01-01", "1996-12-31"), ("1997-01-01", "1997-12-31"))


ACTIVE = {"active": "SELECT d.root, d.date, arg_min(k.symbol, {'a': k.last_date, 'b': k.symbol}) AS active_contract FROM (SELECT DISTINCT root, timestamp::DATE AS date FROM contract_bars) d JOIN contracts k ON k.root = d.root AND d.date BETWEEN k.first_date AND k.last_date GROUP BY d.root, d.date"}


@query("active_contract_range_join", "SELECT * FROM active", ACTIVE)
def _(t: Tables):
    return j.active_contract(t.contract_bars, t.contracts)


def _root_dates(t: Tables):
    return t.contract_bars.select("root", F.to_date("timestamp").alias("date")).distinct()


@query("nth_active_contract", """SELECT d.root, d.date, k.symbol AS contract FROM (SELECT root, date, (SELECT count(*) FROM contracts e WHERE e.root = x.root AND e.last_date < x.date) AS ended FROM (SELECT DISTINCT root, timestamp::DATE AS date FROM contract_bars) x) d
    JOIN (SELECT root, symbol, row_number() OVER (PARTITION BY root ORDER BY last_date, symbol) AS p FROM contracts) k ON k.root = d.root AND k.p = d.ended + 2""")
def _(t: Tables):
    return j.nth_contract(_root_dates(t), t.contracts, 2)


@query("contract_chain", """SELECT b.root, b.symbol, k.last_date, CAST(row_number() OVER (PARTITION BY b.root ORDER BY k.last_date, b.symbol) AS INT) AS position FROM contract_bars b JOIN contracts k ON b.symbol = k.symbol
    WHERE b.timestamp::DATE = (SELECT max(timestamp)::DATE - 400 FROM contract_bars)""")
def _(t: Tables):
    return j.contract_chain(t.contract_bars, t.contracts, t.contract_bars.agg(F.date_sub(F.max("timestamp"), 400).alias("date")))


ROLLS = {"chain_rolls": "SELECT root, symbol AS from_contract, lead(symbol) OVER (PARTITION BY root ORDER BY expiry_month) AS to_contract, last_date - 5 AS roll_date FROM contracts"}


def chain_rolls(t: Tables):
    after = F.lead("symbol").over(Window.partitionBy("root").orderBy("expiry_month"))
    return t.contracts.select("root", F.col("symbol").alias("from_contract"), after.alias("to_contract"), F.date_sub("last_date", 5).alias("roll_date"))


@query("roll_prices", """SELECT r.*, f.close AS from_price, g.close AS to_price FROM chain_rolls r LEFT JOIN contract_bars f ON f.symbol = r.from_contract AND f.timestamp::DATE = r.roll_date
    LEFT JOIN contract_bars g ON g.symbol = r.to_contract AND g.timestamp::DATE = r.roll_date""", ROLLS)
def _(t: Tables):
    return j.roll_prices(chain_rolls(t), t.contract_bars)


@query("price_asof_roll", """SELECT r.*, (SELECT arg_max(close, timestamp) FROM contract_bars b WHERE b.symbol = r.from_contract AND b.timestamp::DATE <= r.roll_date) AS front_price,
    coalesce((SELECT arg_max(close, timestamp) FROM contract_bars b WHERE b.symbol = r.to_contract AND b.timestamp::DATE <= r.roll_date), (SELECT arg_min(close, timestamp) FROM contract_bars b WHERE b.symbol = r.to_contract AND b.timestamp::DATE >= r.roll_date)) AS back_price FROM chain_rolls r""", ROLLS)
def _(t: Tables):
    return j.price_asof_roll(chain_rolls(t), t.contract_bars)


@query("mapping_asof", """SELECT q.root, q.date, m.active_contract FROM (SELECT DISTINCT root, timestamp::DATE + 3 AS date FROM contract_bars WHERE day(timestamp) <= 5) q ASOF LEFT JOIN active m ON q.root = m.root AND q.date >= m.date""", ACTIVE)
def _(t: Tables):
    asked = t.contract_bars.where(F.dayofmonth("timestamp") <= 5).select("root", F.date_add("timestamp", 3).alias("date")).distinct()
    return j.asof(asked, j.active_contract(t.contract_bars, t.contracts), "date", ["root"], ["active_contract"])


@query("missing_dates_anti", "SELECT timestamp::DATE AS date FROM bars EXCEPT SELECT timestamp::DATE AS date FROM bars WHERE symbol = 'Brand#1'")
def _(t: Tables):
    return j.missing_dates(t.bars, t.bars.where("symbol = 'Brand#1'"))


@query("higher_only_days", "SELECT DISTINCT timestamp::DATE AS date, root FROM contract_bars b WHERE month(expiry_month) > 6 AND NOT EXISTS (SELECT 1 FROM contract_bars x WHERE x.root = b.root AND x.timestamp = b.timestamp AND month(x.expiry_month) <= 6)")
def _(t: Tables):
    return j.missing_dates(t.contract_bars.where(F.month("expiry_month") > 6), t.contract_bars.where(F.month("expiry_month") <= 6), ["root"])


@query("wide_outer_merge", "SELECT timestamp::DATE AS date, max(close) FILTER (symbol = 'Brand#1') AS \"Brand#1\", max(close) FILTER (symbol = 'Brand#2') AS \"Brand#2\" FROM bars WHERE symbol IN ('Brand#1', 'Brand#2') GROUP BY 1")
def _(t: Tables):
    return j.wide_series(t.bars, ["Brand#1", "Brand#2"])


@query("export_daily_closes", "SELECT timestamp::DATE AS date, max(close) FILTER (symbol = 'Brand#1') AS b1, max(close) FILTER (symbol = 'Brand#2') AS b2, max(close) FILTER (symbol = 'Brand#3') AS b3 FROM bars WHERE symbol IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY 1")
def _(t: Tables):
    return j.wide_series(t.bars, ["Brand#1", "Brand#2", "Brand#3"]).toDF("date", "b1", "b2", "b3")


@query("rollover_context", """WITH n AS (SELECT symbol, timestamp::DATE AS d, close, lag(close) OVER w AS p, lead(close) OVER w AS x FROM contract_bars WINDOW w AS (PARTITION BY symbol ORDER BY timestamp))
    SELECT r.*, f.p AS from_prev_close, f.close AS from_close, f.x AS from_next_close, g.p AS to_prev_close, g.close AS to_close, g.x AS to_next_close FROM chain_rolls r LEFT JOIN n f ON f.symbol = r.from_contract AND f.d = r.roll_date LEFT JOIN n g ON g.symbol = r.to_contract AND g.d = r.roll_date""", ROLLS)
def _(t: Tables):
    return j.rollover_context(chain_rolls(t), t.contract_bars)


@query("daily_to_intraday", """SELECT id, coalesce(v, first_value(v IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1.0) AS scale FROM (SELECT k.*, d.v FROM ticks k LEFT JOIN
    (SELECT symbol, timestamp::DATE AS date, CAST(count(*) AS DOUBLE) AS v FROM ticks WHERE day(timestamp) % 2 = 0 GROUP BY 1, 2) d ON d.symbol = k.symbol AND d.date = k.timestamp::DATE)""")
def _(t: Tables):
    daily = t.ticks.where(F.dayofmonth("timestamp") % 2 == 0).groupBy("symbol", F.to_date("timestamp").alias("date")).agg(F.count("*").cast("double").alias("scale"))
    return j.daily_to_intraday(t.ticks, daily, "scale").select("id", "scale")


@query("series_source_union", "SELECT coalesce(a.d, b.d) AS date, a.c AS one, b.c AS two FROM (SELECT timestamp::DATE AS d, max(close) AS c FROM bars WHERE symbol = 'Brand#1' GROUP BY 1) a FULL JOIN (SELECT timestamp::DATE AS d, max(close) AS c FROM contract_bars WHERE root = 'PROMO' GROUP BY 1) b ON a.d = b.d")
def _(t: Tables):
    return j.compare_series(t.bars.where("symbol = 'Brand#1'"), t.contract_bars.where("root = 'PROMO'"), "one", "two")


@query("series_ratio", "SELECT a.timestamp, a.close AS first, b.close AS second, round(a.close / nullif(b.close, 0), 6) AS ratio FROM bars a JOIN bars b ON a.timestamp = b.timestamp WHERE a.symbol = 'Brand#1' AND b.symbol = 'Brand#2'")
def _(t: Tables):
    return j.series_ratio(t.bars, "Brand#1", "Brand#2")


@query("futures_basis", "SELECT f.symbol, f.timestamp, f.close, i.close AS index_close, round(f.close - i.close, 6) AS basis, round((f.close - i.close) * 100.0 / nullif(i.close, 0), 6) AS basis_pct FROM contract_bars f JOIN bars i ON f.timestamp = i.timestamp WHERE i.symbol = 'Brand#1'")
def _(t: Tables):
    return j.basis(t.contract_bars, t.bars.where("symbol = 'Brand#1'"))


@query("market_with_economic", "SELECT b.symbol, b.timestamp, b.close, max(e.value) FILTER (e.indicator = 'FRANCE') AS \"FRANCE\", max(e.value) FILTER (e.indicator = 'GERMANY') AS \"GERMANY\" FROM bars b LEFT JOIN econ e ON b.timestamp = e.timestamp GROUP BY 1, 2, 3")
def _(t: Tables):
    return j.with_indicators(t.bars.select("symbol", "timestamp", "close"), t.econ, ["FRANCE", "GERMANY"])


def _cal(first: str, last: str, extra: str = "") -> str:
    return f"SELECT CAST(d AS DATE) AS d FROM (SELECT unnest(generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY)) AS d) WHERE dayofweek(d) NOT IN (0, 6) AND CAST(d AS DATE) NOT IN ({HOLIDAY_LIST})"


CAL = {"cal": _cal("1994-12-01", "2002-12-31"), "cal24": _cal("2022-12-01", "2025-03-31"), "ord": "SELECT d, row_number() OVER (ORDER BY d) AS o FROM cal", "ord24": "SELECT d, row_number() OVER (ORDER BY d) AS o FROM cal24"}


def _calendar(t: Tables, first: str = "1994-12-01", last: str = "2002-12-31"):
    return c.business_calendar(t.spark, first, last)


@query("business_calendar", "SELECT c.d AS date, count(DISTINCT b.symbol) AS symbols FROM cal c LEFT JOIN bars b ON b.timestamp::DATE = c.d GROUP BY 1", CAL)
def _(t: Tables):
    rows = t.bars.select("symbol", F.to_date("timestamp").alias("date"))
    return _calendar(t).join(rows, "date", "left").groupBy("date").agg(F.count_distinct("symbol").alias("symbols"))


_UPTO = "(SELECT max(o) FROM ord WHERE d <= {0})"


@query("trading_day_ordinal", f"SELECT k.symbol, k.last_date, (SELECT d FROM ord WHERE o = {_UPTO.format('k.last_date')} - 3) AS shifted FROM contracts k", CAL)
def _(t: Tables):
    return c.trading_day_offset(t.contracts.select("symbol", "last_date"), _calendar(t), -3, "last_date")


_MONTHS = "SELECT DISTINCT expiry_month AS m FROM contracts"
_THIRD = "{0} + ((12 - isodow({0})) % 7)::INT + 14"


@query("nth_weekday", f"SELECT m AS month, CAST({_THIRD.format('m')} AS DATE) AS third_friday, CAST(m + ((8 - isodow(m)) % 7)::INT AS DATE) AS first_monday FROM ({_MONTHS})")
def _(t: Tables):
    month = F.col("month")
    return t.contracts.select(F.col("expiry_month").alias("month")).distinct().select("month", c.third_friday(month).alias("third_friday"), c.nth_weekday(month, "Mon", 1).alias("first_monday"))


_SETTLE = f"""SELECT m AS month, (SELECT max(d) FROM cal24 WHERE d <= CASE WHEN f IN (SELECT d FROM cal24) THEN f - 30 ELSE f - 31 END) AS settlement FROM (SELECT m, CAST({_THIRD.format("CAST(m + INTERVAL 1 MONTH AS DATE)")} AS DATE) AS f FROM (SELECT CAST(unnest(generate_series(DATE '2023-01-01', DATE '2024-12-01', INTERVAL 1 MONTH)) AS DATE) AS m))"""


@query("vix_settlement_calendar", f"SELECT month, settlement, (SELECT max(d) FROM cal24 WHERE d < settlement) AS last_trading_day, (SELECT count(*) FROM ticks WHERE timestamp::DATE = settlement) AS ticks FROM ({_SETTLE})", CAL)
def _(t: Tables):
    settled = c.vix_settlements(t.spark, 2023, 2024)
    return settled.join(t.ticks.select(F.to_date("timestamp").alias("settlement"), "id"), "settlement", "left").groupBy("month", "settlement", "last_trading_day").agg(F.count("id").alias("ticks"))


@query("expected_expiries", f"SELECT k.symbol, (SELECT max(d) FROM cal WHERE d <= CAST({_THIRD.format('k.expiry_month')} AS DATE) - 2) AS expiry FROM contracts k", CAL)
def _(t: Tables):
    year = F.year("expiry_month")
    first, last = t.contracts.agg(F.min(year), F.max(year)).first()
    expiries = c.expected_expiries(t.spark, first or 1995, last or 1995).withColumnRenamed("month", "expiry_month")
    return t.contracts.join(F.broadcast(expiries), "expiry_month", "left").select("symbol", "expiry")


#: An expiry rule for each kind, by root; other roots have none.
EXPIRY_RULES = (("PROMO", "weekday", 4, 3, None), ("ECONOMY", "weekday", 0, 5, None), ("SMALL", "before_day", None, 3, 25), ("LARGE", "before_last", None, 3, None), ("STANDARD", "vx", None, None, None))
_RULE_ROWS = ", ".join("({})".format(", ".join("NULL" if v is None else repr(v) for v in row)) for row in EXPIRY_RULES)
RULE_CTES = {
    **CAL,
    "rules": f"SELECT * FROM (VALUES {_RULE_ROWS}) v(root, kind, weekday, n, day)",
    "ranked": "SELECT d, date_trunc('month', d)::DATE AS m, isodow(d) - 1 AS w, row_number() OVER (PARTITION BY date_trunc('month', d), isodow(d) ORDER BY d) AS nth, row_number() OVER (PARTITION BY date_trunc('month', d) ORDER BY d DESC) - 1 AS back FROM cal",
}


@query("rule_expiry", """SELECT k.symbol, kind AS rule, coalesce(CASE kind WHEN 'weekday' THEN (SELECT d FROM ranked WHERE m = expiry_month AND w = weekday AND nth = n) WHEN 'before_last' THEN (SELECT d FROM ranked WHERE m = expiry_month AND back = n)
    WHEN 'before_day' THEN (SELECT d FROM ord WHERE o = (SELECT max(o) FROM ord WHERE d < expiry_month + day - 1) - n + 1 AND d >= expiry_month - 5)
    WHEN 'vx' THEN (SELECT coalesce((SELECT max(d) FROM cal WHERE d <= f.d - 30 AND d >= f.d - 35), f.d - 30) FROM ranked f WHERE f.m = (expiry_month + INTERVAL 1 MONTH)::DATE AND f.w = 4 AND f.nth = 3) END, expiry_month + 14) AS expiry FROM contracts k LEFT JOIN rules USING (root)""", RULE_CTES)
def _(t: Tables):
    rules = t.spark.createDataFrame(EXPIRY_RULES, c.RULES)
    contracts = t.contracts.select("root", "symbol", F.col("expiry_month").alias("month"))
    return c.rule_expiry(contracts, rules, _calendar(t)).select("symbol", "rule", "expiry")


@query("holiday_label", """SELECT date, CASE WHEN m = 1 AND d = 1 THEN 'New Year' WHEN m = 1 AND w = 1 AND d BETWEEN 15 AND 21 THEN 'Martin Luther King Day' WHEN m = 2 AND w = 1 AND d BETWEEN 15 AND 21 THEN 'Presidents Day' WHEN m = 5 AND w = 1 AND d >= 25 THEN 'Memorial Day'
    WHEN m = 6 AND d = 19 THEN 'Juneteenth' WHEN m = 7 AND d = 4 THEN 'Independence Day' WHEN m = 9 AND w = 1 AND d <= 7 THEN 'Labor Day' WHEN m = 11 AND w = 4 AND d BETWEEN 22 AND 28 THEN 'Thanksgiving' WHEN m = 12 AND d = 25 THEN 'Christmas' END AS holiday
    FROM (SELECT DISTINCT timestamp::DATE AS date, month(timestamp) AS m, day(timestamp) AS d, isodow(timestamp) AS w FROM bars)""")
def _(t: Tables):
    return t.bars.select(F.to_date("timestamp").alias("date")).distinct().withColumn("holiday", c.holiday_label(F.col("date")))


@query("inferred_holidays", "SELECT timestamp::DATE AS date FROM dirty_bars GROUP BY 1 HAVING count(*) FILTER (close > 0) = 0")
def _(t: Tables):
    return c.inferred_holidays(t.dirty_bars)


@query("contract_codes", f"SELECT DISTINCT root, root || substr('{MONTH_CODES}', m, 1) || right(CAST(y AS VARCHAR), 2) AS symbol, make_date(y, m, 1) AS month FROM contracts, (SELECT unnest(range(1995, 2002)) AS y), (SELECT unnest([3, 6, 9, 12]) AS m) WHERE make_date(y, m, 1) >= '1996-01-01' AND make_date(y, m, 1) - 270 <= DATE '2000-01-01'")
def _(t: Tables):
    return s.active_contracts(s.contract_codes(t.contracts.select("root").distinct(), range(1995, 2002), "HMUZ"), "1996-01-01", "2000-01-01")


@query("parse_contract", "SELECT symbol, root AS parsed_root, CAST(month(expiry_month) AS INT) AS parsed_month, CAST(year(expiry_month) AS INT) AS parsed_year FROM contracts")
def _(t: Tables):
    return s.parse_contract(t.contracts).select("symbol", "parsed_root", "parsed_month", "parsed_year")


@query("parse_continuous", "SELECT DISTINCT '@' || root || '=' || p || '02X' || a || '_d' AS name, root, CAST(p AS INT) AS position, 2 AS roll_days, a AS adjustment, 'd' AS suffix FROM contracts, (VALUES ('1'), ('2')) v(p), (VALUES ('N'), ('C')) u(a)")
def _(t: Tables):
    parts = t.contracts.select("root").distinct().withColumn("p", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("a", F.explode(F.array(F.lit("N"), F.lit("C"))))
    names = parts.select(F.concat(s.continuous_name(F.col("root"), F.col("p"), F.lit(2), F.col("a")), F.lit("_d")).alias("name"))
    return s.parse_continuous(names)


@query("roll_calendar_offsets", f"SELECT k.root, k.symbol, lpad(CAST(n AS VARCHAR), 2, '0') || 'X' AS roll_type, (SELECT d FROM ord WHERE o = {_UPTO.format('k.last_date')} - n) AS roll_date FROM contracts k, (VALUES (1), (2), (3)) v(n)", CAL)
def _(t: Tables):
    return c.roll_offsets(t.contracts, _calendar(t))


@query("near_roll", "SELECT root, min(r) AS next_roll, date_diff('day', DATE '1998-06-01', min(r)) AS days_to_roll FROM (SELECT root, last_date - 5 AS r FROM contracts) WHERE r >= DATE '1998-06-01' - 40 GROUP BY root HAVING min(r) - DATE '1998-06-01' <= 40")
def _(t: Tables):
    return c.near_roll(t.contracts.select("root", F.date_sub("last_date", 5).alias("roll_date")), "1998-06-01", 40)


@query("futures_order", "SELECT symbol, row_number() OVER (PARTITION BY root ORDER BY expiry_month) AS place FROM contracts".replace("row_number()", "CAST(row_number()").replace("expiry_month)", "expiry_month) AS INT)"))
def _(t: Tables):
    parsed = s.parse_contract(t.contracts)
    return parsed.select("symbol", F.row_number().over(Window.partitionBy("parsed_root").orderBy(*s.futures_order(parsed))).alias("place"))


@query("symbol_labels", f"SELECT DISTINCT symbol, CASE WHEN regexp_matches(symbol, '^[A-Z]{{2,}}[{MONTH_CODES}][0-9]{{2}}$') THEN root ELSE symbol END AS base, '1d' AS label FROM contracts")
def _(t: Tables):
    return t.contracts.select("symbol", s.base_symbol(F.col("symbol")).alias("base"), s.interval_label(F.lit(1), F.lit("daily")).alias("label")).distinct()
