"""Queries: rolls and continuous series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebar.functions.calendars import business_calendar
from tidebar.operators import continuous as c
from tidebar.operators import rolls as o
from tidebar.operators.joins import active_contract
from tidebar.plans.p_joins import ACTIVE
from tidebar.plans.register import query
from tidebar.sources.adapters import Tables, contracts_of


def _cross(measure: str, ratio: float) -> str:
    return f"""SELECT p.root, p.from_contract, p.to_contract, p.expiry_month, coalesce(min(a.timestamp::DATE) FILTER (b.{measure} >= {ratio} * a.{measure}), any_value(p.last_date) - 5) AS roll_date, any_value(p.last_date) + 1 AS expiration_date,
    CASE WHEN count(*) FILTER (b.{measure} >= {ratio} * a.{measure}) > 0 THEN 'crossover' ELSE 'threshold' END AS reason FROM roll_pairs_all p JOIN contract_bars a ON a.symbol = p.from_contract LEFT JOIN contract_bars b ON b.symbol = p.to_contract AND b.timestamp = a.timestamp GROUP BY ALL"""


C = {
    **ACTIVE,
    "roll_pairs_all": "SELECT * FROM (SELECT root, symbol AS from_contract, lead(symbol) OVER (PARTITION BY root ORDER BY expiry_month) AS to_contract, expiry_month, last_date FROM contracts) WHERE to_contract IS NOT NULL",
    "v_rolls": _cross("volume", 2.0),
    "oi_rolls": _cross("open_interest", 1.5),
    "segs": "SELECT root, symbol, max(s) AS s, max(e) AS e FROM (SELECT root, from_contract AS symbol, NULL::DATE AS s, roll_date AS e FROM v_rolls UNION ALL SELECT root, to_contract, roll_date, NULL FROM v_rolls) GROUP BY root, symbol",
    "stitched": "SELECT b.root, b.symbol AS underlying_symbol, b.expiry_month, b.timestamp, b.open, b.high, b.low, b.close, b.volume, b.open_interest FROM contract_bars b JOIN segs g ON g.root = b.root AND g.symbol = b.symbol WHERE (s IS NULL OR b.timestamp >= s) AND (e IS NULL OR b.timestamp < e) QUALIFY row_number() OVER (PARTITION BY b.root, b.timestamp ORDER BY b.expiry_month, b.symbol) = 1",
    "priced": "SELECT r.root, r.from_contract, r.to_contract, r.roll_date, coalesce(g.close / nullif(f.close, 0), 1.0) AS ratio, coalesce(g.close - f.close, 0.0) AS gap FROM v_rolls r LEFT JOIN contract_bars f ON f.symbol = r.from_contract AND f.timestamp = r.roll_date LEFT JOIN contract_bars g ON g.symbol = r.to_contract AND g.timestamp = r.roll_date",
    "facts": "SELECT root, to_contract AS underlying_symbol, exp(sum(ln(ratio)) OVER a) AS ratio_before, exp(sum(ln(ratio)) OVER z) AS ratio_after, sum(gap) OVER a AS gap_before, coalesce(sum(gap) OVER z, 0.0) AS gap_after FROM priced WINDOW a AS (PARTITION BY root ORDER BY roll_date, from_contract ROWS UNBOUNDED PRECEDING), z AS (PARTITION BY root ORDER BY roll_date, from_contract ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)",
    "totals": "SELECT root, exp(sum(ln(ratio))) AS ratio_all, sum(gap) AS gap_all FROM priced GROUP BY root",
    "facted": "SELECT s.*, coalesce(ratio_before, 1.0) AS rb, CASE WHEN f.underlying_symbol IS NULL THEN ratio_all ELSE coalesce(ratio_after, 1.0) END AS ra, coalesce(gap_before, 0.0) AS gb, CASE WHEN f.underlying_symbol IS NULL THEN gap_all ELSE gap_after END AS ga FROM stitched s LEFT JOIN facts f ON f.root = s.root AND f.underlying_symbol = s.underlying_symbol LEFT JOIN totals t ON t.root = s.root",
    "mapped": "SELECT * FROM (SELECT d.root, d.date, CAST(row_number() OVER (PARTITION BY d.root, d.date ORDER BY k.last_date, k.symbol) AS INT) AS position, k.symbol FROM (SELECT DISTINCT root, timestamp::DATE AS date FROM contract_bars) d JOIN contracts k ON k.root = d.root AND k.last_date >= d.date) WHERE position <= 3",
}


def vrolls(t: Tables):
    return o.rolls_volume(t.contract_bars, t.contracts)


def stitched(t: Tables):
    return c.unadjusted(t.contract_bars, vrolls(t))


def termed(t: Tables):
    """The unadjusted series with the terms of all adjustments: bars are read once for it, and once for its rolls with their prices."""
    return c.unadjusted(t.contract_bars, o.rolls_volume(t.contract_bars, t.contracts, closes=True), terms=True)


def _rounded(df, factor: str = "adjustment_factor"):
    return df.select("root", "timestamp", "underlying_symbol", *(F.round(x, 4).alias(x) for x in ("open", "close", factor)))


def _adjusted(close: str, factor: str) -> str:
    return f"SELECT root, timestamp, underlying_symbol, round({close.format('open')}, 4) AS open, round({close.format('close')}, 4) AS close, round({factor}, 4) AS adjustment_factor FROM facted"


@query("rolls_volume", "SELECT * FROM v_rolls", C)
def _(t: Tables):
    return vrolls(t)


@query("rolls_open_interest", "SELECT * FROM oi_rolls", C)
def _(t: Tables):
    return o.rolls_open_interest(t.contract_bars, t.contracts)


_TF = "CAST(expiry_month + ((12 - isodow(expiry_month)) % 7)::INT + 14 AS DATE)"


@query("rolls_calendar", f"SELECT root, from_contract, to_contract, expiry_month, CAST(CASE WHEN isodow(raw) >= 6 THEN raw - (isodow(raw) - 5)::INT ELSE raw END AS DATE) AS roll_date FROM (SELECT *, {_TF} - 5 AS raw FROM roll_pairs_all)", C)
def _(t: Tables):
    return o.rolls_calendar(t.contracts)


@query("rolls_auto", "SELECT * FROM v_rolls", C)
def _(t: Tables):
    return o.rolls(t.contract_bars, t.contracts)


@query("rolls_last_window", """SELECT p.root, p.from_contract, p.to_contract, max(a.timestamp::DATE) FILTER (coalesce(b.volume, 0) > coalesce(a.volume, 0)) AS roll_date FROM roll_pairs_all p JOIN (SELECT * FROM contract_bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) <= 5) a ON a.symbol = p.from_contract
    LEFT JOIN contract_bars b ON b.symbol = p.to_contract AND b.timestamp = a.timestamp GROUP BY ALL""", C)
def _(t: Tables):
    return o.rolls_last_window(t.contract_bars, t.contracts)


@query("roll_pairs", "SELECT * FROM (SELECT root, last_date - 5 AS roll_date, lead(symbol, 1) OVER w AS from_contract, lead(symbol, 2) OVER w AS to_contract FROM contracts WINDOW w AS (PARTITION BY root ORDER BY expiry_month)) WHERE from_contract IS NOT NULL AND to_contract IS NOT NULL")
def _(t: Tables):
    return o.roll_pairs(t.contracts.withColumn("roll_date", F.date_sub("last_date", 5)), 2)


@query("rollovers_in_range", """SELECT x.*, f.close AS from_price, g.close AS to_price FROM (SELECT root, contract, roll_date, roll_type, to_contract FROM (SELECT *, max(CASE WHEN roll_date < '1997-01-01' THEN roll_date END) OVER (PARTITION BY root) AS b, min(CASE WHEN roll_date > '1997-12-31' THEN roll_date END) OVER (PARTITION BY root) AS a FROM (SELECT root, symbol AS contract, last_date - 5 AS roll_date, 'volume' AS roll_type, lead(symbol) OVER (PARTITION BY root ORDER BY last_date - 5, symbol) AS to_contract FROM contracts))
    WHERE roll_date BETWEEN '1997-01-01' AND '1997-12-31' OR roll_date = a OR roll_date = b) x LEFT JOIN contract_bars f ON f.symbol = contract AND f.timestamp = roll_date LEFT JOIN contract_bars g ON g.symbol = to_contract AND g.timestamp = roll_date""")
def _(t: Tables):
    rolls = t.contracts.select("root", F.col("symbol").alias("contract"), F.date_sub("last_date", 5).alias("roll_date"), F.lit("volume").alias("roll_type"))
    return o.rollovers_in_range(rolls, "1997-01-01", "1997-12-31", bars=t.contract_bars)


#: Sessions are weekdays of the years of the tables; a contract expires on its last day.
SESSIONS = ("1995-01-01", "2002-12-31")
NEAR = {
    "sessions": f"SELECT d::DATE AS d, row_number() OVER (ORDER BY d) AS o FROM range(DATE '{SESSIONS[0]}', DATE '{SESSIONS[1]}' + 1, INTERVAL 1 DAY) r(d) WHERE isodow(d) < 6",
    "near_two": "SELECT x.*, o, o >= (SELECT max(o) FROM sessions WHERE d < last_date) - 6 AS near FROM (SELECT root, date, max(symbol) FILTER (p = 1) AS nearest, max(symbol) FILTER (p = 2) AS second, max(last_date) FILTER (p = 1) AS last_date FROM (SELECT a.root, a.date, k.symbol, k.last_date, row_number() OVER (PARTITION BY a.root, a.date ORDER BY k.last_date, k.symbol) AS p FROM (SELECT DISTINCT root, timestamp::DATE AS date FROM contract_bars WHERE isodow(timestamp) < 6) a JOIN contracts k ON k.root = a.root AND k.last_date >= a.date) WHERE p <= 2 GROUP BY root, date) x JOIN sessions ON d = date",
    "near_volumes": "SELECT n.root, n.date, v.symbol, avg(v.volume) AS mean_volume FROM near_two n JOIN (SELECT symbol, o, volume FROM contract_bars JOIN sessions ON d = timestamp::DATE) v ON (v.symbol = n.nearest OR v.symbol = n.second) AND v.o BETWEEN n.o - 7 AND n.o WHERE near AND second IS NOT NULL GROUP BY 1, 2, 3",
    "near_days": "SELECT n.root, n.date, nearest, second, coalesce(near, false) AS near, a.mean_volume AS nearest_volume, b.mean_volume AS second_volume, CASE WHEN b.mean_volume > a.mean_volume THEN second ELSE nearest END AS active_contract FROM near_two n LEFT JOIN near_volumes a ON a.root = n.root AND a.date = n.date AND a.symbol = nearest LEFT JOIN near_volumes b ON b.root = n.root AND b.date = n.date AND b.symbol = second",
    "near_active": "SELECT root, date, active_contract, CASE WHEN before <> active_contract THEN before END AS rolled_from FROM (SELECT *, lag(active_contract) OVER (PARTITION BY root ORDER BY date) AS before FROM near_days)",
}


def _sessions(t: Tables):
    return business_calendar(t.spark, *SESSIONS)


@query("avg_volume_lookback", "SELECT root, date, nearest, second, near, round(nearest_volume, 6) AS nearest_volume, round(second_volume, 6) AS second_volume, active_contract FROM near_days", NEAR)
def _(t: Tables):
    out = o.near_expiry(t.contract_bars, t.contracts, _sessions(t))
    return out.withColumns({x: F.round(x, 6) for x in ("nearest_volume", "second_volume")})


@query("active_contract_by_volume", "SELECT * FROM near_active", NEAR)
def _(t: Tables):
    return o.active_by_volume(t.contract_bars, t.contracts, _sessions(t))


@query("active_contract_rolls", "SELECT root, date AS roll_date, rolled_from AS from_contract, active_contract AS to_contract FROM near_active WHERE rolled_from IS NOT NULL", NEAR)
def _(t: Tables):
    return o.rolls_of(o.active_by_volume(t.contract_bars, t.contracts, _sessions(t)))


def _dates(t: Tables):
    return t.contract_bars.select("root", F.to_date("timestamp").alias("date")).distinct()


@query("continuous_mapping", "SELECT * FROM mapped", C)
def _(t: Tables):
    return o.continuous_mapping(_dates(t), t.contracts, 3)


@query("continuous_unadjusted", "SELECT root, timestamp, underlying_symbol, open, high, low, close, volume FROM stitched", C)
def _(t: Tables):
    return stitched(t).select("root", "timestamp", "underlying_symbol", "open", "high", "low", "close", "volume")


@query("continuous_nth", """SELECT m.root, m.date, m.position, m.symbol AS underlying_symbol, b.open, b.close, CASE WHEN b.close > 0 THEN b.close END AS settle, coalesce(b.volume, 0) AS volume, coalesce(b.open_interest, 0) AS open_interest FROM mapped m LEFT JOIN contract_bars b ON b.symbol = m.symbol AND b.timestamp = m.date""", C)
def _(t: Tables):
    out = c.continuous_nth(t.contract_bars, o.continuous_mapping(_dates(t), t.contracts, 3))
    return out.select("root", "date", "position", "underlying_symbol", "open", "close", "settle", "volume", "open_interest")


@query("panama_ratio", _adjusted("{} / rb", "rb"), C)
def _(t: Tables):
    return _rounded(c.panama_ratio(termed(t)))


@query("panama_additive", _adjusted("{} - gb", "-gb"), C)
def _(t: Tables):
    return _rounded(c.panama_additive(termed(t)))


@query("panama_split_ratio", _adjusted("{} * pow(ra, 0.75) * pow(rb, -0.25)", "pow(ra, 0.75) * pow(rb, -0.25)"), C)
def _(t: Tables):
    return _rounded(c.panama_split(termed(t), lam=0.75))


@query("back_adjust_constant", _adjusted("{} + ga", "ga"), C)
def _(t: Tables):
    return _rounded(c.back_adjust_constant(termed(t)))


def _at_instant(position: int, offset: str) -> str:
    """The series at a position; offset: from the roll date's midnight to the instant, in UTC."""
    return f"""WITH p AS (SELECT root, roll_date + INTERVAL '{offset}' AS i, lead(symbol, {position - 1}) OVER w AS f, lead(symbol, {position}) OVER w AS b FROM tick_contracts WINDOW w AS (PARTITION BY root ORDER BY expiry_month)),
    g AS (SELECT p.root, p.i, p.f, p.b, coalesce((SELECT arg_max(close, timestamp) FROM contract_ticks x WHERE x.symbol = p.f AND x.timestamp <= p.i) - coalesce((SELECT arg_max(close, timestamp) FROM contract_ticks x WHERE x.symbol = p.b AND x.timestamp <= p.i), (SELECT arg_min(close, timestamp) FROM contract_ticks x WHERE x.symbol = p.b AND x.timestamp > p.i)), 0.0) AS gap FROM p WHERE f IS NOT NULL AND b IS NOT NULL),
    s AS (SELECT *, sum(gap) OVER (PARTITION BY root ORDER BY i DESC) AS gaps FROM g), l AS (SELECT root, symbol, max(a) AS a, max(z) AS z, max(b) AS b, max(gaps) AS gaps FROM (SELECT root, f AS symbol, NULL::TIMESTAMP AS a, i AS z, b, gaps FROM s UNION ALL SELECT root, b, i, NULL, NULL, NULL FROM s) GROUP BY 1, 2)
    SELECT t.root, t.timestamp, t.symbol AS underlying_symbol, l.b AS next_contract, round(t.open - coalesce(gaps, 0), 4) AS open, round(t.close - coalesce(gaps, 0), 4) AS close, round(0 - coalesce(gaps, 0), 4) AS adjustment_factor FROM contract_ticks t JOIN l ON l.root = t.root AND l.symbol = t.symbol WHERE (a IS NULL OR t.timestamp > a) AND (z IS NULL OR t.timestamp <= z)"""


def _back_adjusted(t: Tables, position: int):
    out = c.back_adjust_at(t.contract_ticks, t.tick_contracts, position, "16:15:00", "America/New_York")
    return out.select("root", "timestamp", "underlying_symbol", "next_contract", *(F.round(x, 4).alias(x) for x in ("open", "close", "adjustment_factor")))


# in January New York is five hours behind UTC
@query("back_adjust_at_instant", _at_instant(1, "21 hours 15 minutes"))
def _(t: Tables):
    return _back_adjusted(t, 1)


@query("back_adjust_second_position", _at_instant(2, "21 hours 15 minutes"))
def _(t: Tables):
    return _back_adjusted(t, 2)


@query("back_adjust_reverse", "SELECT root, timestamp, underlying_symbol, close, round(close + ga, 4) AS adj_close, round(ga, 4) AS adj_factor FROM facted", C)
def _(t: Tables):
    out = c.back_adjust_reverse(termed(t))
    return out.select("root", "timestamp", "underlying_symbol", "close", F.round("adj_close", 4).alias("adj_close"), F.round("adj_factor", 4).alias("adj_factor"))


@query("continuous_append", "SELECT root, timestamp, underlying_symbol, CASE WHEN timestamp <= '1998-01-01' THEN -1.0 ELSE close END AS close FROM stitched", C)
def _(t: Tables):
    from tidebar.plans.p_tables import scratch

    built = stitched(t).select("root", "timestamp", "underlying_symbol", "close")
    path = f"{scratch(t)}/continuous"  # the series as it was stored before, as a table of its own
    built.where("timestamp <= '1998-01-01'").withColumn("close", F.lit(-1.0)).write.parquet(path)
    return c.append_new(t.spark.read.parquet(path), built)


@query("roll_analysis", """SELECT * FROM (SELECT root, timestamp, lag(underlying_symbol) OVER w AS from_contract, underlying_symbol AS to_contract, round(close / nullif(lag(close) OVER w, 0), 6) AS factor, round(lag(close, 1) OVER w / nullif(lag(close, 6) OVER w, 0) - 1, 6) AS return_before,
    round(lead(close, 5) OVER w / nullif(close, 0) - 1, 6) AS return_after, round(stddev_samp(ret) OVER (PARTITION BY root) * sqrt(252.0) * 100, 4) AS volatility FROM (SELECT *, close / nullif(lag(close) OVER (PARTITION BY root ORDER BY timestamp), 0) - 1 AS ret FROM stitched) WINDOW w AS (PARTITION BY root ORDER BY timestamp)) WHERE from_contract <> to_contract""", C)
def _(t: Tables):
    return c.roll_analysis(stitched(t))


_DAYS = """SELECT s.root, s.timestamp, s.underlying_symbol, x.active_contract, s.close, b.close AS contract_close, CASE WHEN x.p IS NOT NULL AND x.p <> x.active_contract THEN 'ROLLOVER' ELSE 'NORMAL' END AS day_type FROM stitched s LEFT JOIN (SELECT *, lag(active_contract) OVER (PARTITION BY root ORDER BY date) AS p FROM active) x
    ON x.root = s.root AND x.date = s.timestamp::DATE LEFT JOIN contract_bars b ON b.symbol = x.active_contract AND b.timestamp = s.timestamp"""


@query("rollover_first_month", _DAYS, C)
def _(t: Tables):
    return c.rollover_days(stitched(t), t.contract_bars, active_contract(t.contract_bars, t.contracts))


@query("consistency_check", f"""SELECT root, timestamp, round(abs(close - contract_close), 6) AS difference, round(abs(close - contract_close) * 100.0 / nullif(contract_close, 0), 6) AS difference_pct, CASE WHEN abs(close - contract_close) / nullif(contract_close, 0) > 0.01 THEN 'WARNING' WHEN contract_close IS NULL THEN 'MISSING' ELSE 'OK' END AS status FROM ({' '.join(_DAYS.split())})""", C)
def _(t: Tables):
    return c.consistency_check(stitched(t), t.contract_bars, active_contract(t.contract_bars, t.contracts))


@query("verify_rollovers", """WITH a AS (SELECT DISTINCT root, timestamp::DATE AS date FROM (SELECT *, lag(underlying_symbol) OVER (PARTITION BY root ORDER BY timestamp) AS p FROM stitched) WHERE p <> underlying_symbol), e AS (SELECT DISTINCT root, roll_date AS date FROM v_rolls)
    SELECT coalesce(a.root, e.root) AS root, coalesce(a.date, e.date) AS date, CASE WHEN a.root IS NOT NULL AND e.root IS NOT NULL THEN 'MATCH' WHEN a.root IS NOT NULL THEN 'UNEXPECTED' ELSE 'MISSING' END AS status FROM a FULL JOIN e ON a.root = e.root AND a.date = e.date""", C)
def _(t: Tables):
    from tidebar.operators.windows import rollover_events

    actual = rollover_events(stitched(t)).select("root", F.to_date("timestamp").alias("date"))
    return c.verify_rollovers(actual, vrolls(t).select("root", F.col("roll_date").alias("date")))


#: Positions that are verified: each against the mapping of the nearest contracts.
POSITIONS = 3
VERIFY = {
    **C,
    "chain": "SELECT root, symbol, expiry_month, roll_date FROM (SELECT root, from_contract AS symbol, expiry_month, roll_date FROM v_rolls UNION ALL SELECT root, to_contract, NULL, NULL FROM v_rolls QUALIFY row_number() OVER (PARTITION BY root ORDER BY expiry_month DESC, from_contract DESC) = 1)",
    "lives": "SELECT root, p AS position, symbol, CASE p WHEN 1 THEN r1 WHEN 2 THEN r2 ELSE r3 END AS s, CASE p WHEN 1 THEN r0 WHEN 2 THEN r1 ELSE r2 END AS e FROM (SELECT root, symbol, roll_date AS r0, lag(roll_date, 1) OVER w AS r1, lag(roll_date, 2) OVER w AS r2, lag(roll_date, 3) OVER w AS r3, row_number() OVER w AS k FROM chain WINDOW w AS (PARTITION BY root ORDER BY expiry_month NULLS LAST, symbol)), (VALUES (1), (2), (3)) v(p) WHERE k >= p",
    "stitched_all": "SELECT b.root, position, b.symbol AS underlying_symbol, b.timestamp, b.close FROM contract_bars b JOIN lives g ON g.root = b.root AND g.symbol = b.symbol WHERE (s IS NULL OR b.timestamp >= s) AND (e IS NULL OR b.timestamp < e) QUALIFY row_number() OVER (PARTITION BY b.root, position, b.timestamp ORDER BY b.expiry_month, b.symbol) = 1",
}
_STATUS = """SELECT root, position, timestamp, underlying_symbol, expected_symbol, CASE WHEN underlying_symbol IS NULL THEN 'MISSING_UNDERLYING' WHEN close IS NULL THEN 'MISSING_CONTINUOUS_PRICE' WHEN cc IS NULL THEN 'MISSING_CONTRACT_PRICE' WHEN rolled AND off > 0.001 THEN 'ROLLOVER_PRICE_MISMATCH' WHEN rolled AND due THEN 'ROLLOVER_ON_SETTLEMENT_DATE'
    WHEN rolled THEN 'ROLLOVER_NOT_ON_SETTLEMENT_DATE' WHEN due AND p IS NOT NULL THEN 'MISSED_ROLLOVER' WHEN expected_symbol <> underlying_symbol THEN 'UNDERLYING_MISMATCH' WHEN off > 0.01 THEN 'LARGE_PRICE_DIFF' WHEN off > 0.001 THEN 'SMALL_PRICE_DIFF' ELSE 'OK' END AS status FROM
    (SELECT s.*, x.symbol AS expected_symbol, b.close AS cc, abs((s.close - b.close) / nullif(b.close, 0)) AS off, coalesce(s.p <> s.underlying_symbol, false) AS rolled, v.roll_date IS NOT NULL AS due FROM (SELECT *, lag(underlying_symbol) OVER (PARTITION BY root, position ORDER BY timestamp) AS p FROM stitched_all) s
    LEFT JOIN mapped x ON x.root = s.root AND x.position = s.position AND x.date = s.timestamp::DATE LEFT JOIN contract_bars b ON b.symbol = s.underlying_symbol AND b.timestamp = s.timestamp LEFT JOIN (SELECT DISTINCT root, roll_date FROM v_rolls) v ON v.root = s.root AND v.roll_date = s.timestamp::DATE)"""


def _verified(t: Tables):
    from tidebar.plans.p_tables import scratch

    # the contracts' bars are made once, and read by all that follows
    path = f"{scratch(t)}/contract_bars"
    t.contract_bars.select("root", "symbol", "expiry_month", "timestamp", "close", "volume").write.parquet(path)
    bars = t.spark.read.parquet(path)
    contracts = contracts_of(bars)
    rolls = o.rolls_volume(bars, contracts)
    mapping = o.continuous_mapping(bars.select("root", F.to_date("timestamp").alias("date")).distinct(), contracts, POSITIONS)
    return c.verify_continuous(c.unadjusted_positions(bars, rolls, POSITIONS), bars, mapping, rolls.select("root", F.col("roll_date").alias("date")))


@query("verify_continuous", _STATUS, VERIFY)
def _(t: Tables):
    return _verified(t)


@query("verify_summary", f"SELECT position, status, count(*) AS n FROM ({' '.join(_STATUS.split())}) GROUP BY position, status", VERIFY)
def _(t: Tables):
    return _verified(t).groupBy("position", "status").agg(F.count("*").alias("n"))


@query("adjustment_registry", _adjusted("{} + ga", "ga"), C)
def _(t: Tables):
    return _rounded(c.build("@ANY=102XC_d", t.contract_bars, o.rolls_volume(t.contract_bars, t.contracts, closes=True)))


