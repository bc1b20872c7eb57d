"""Operators on small frames: the fixtures of FIXTURES.md, invariants, and pandas where SQL is no oracle."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidebar.functions import calendars, symbols
from tidebar.functions.scalars import business_days_between
from tidebar.operators import cleaning, continuous, gaps, indicators, joins, quality, risk, rolls
from tidebar.plans import catalog
from tidebar.plans.p_continuous import stitched, vrolls
from tidebar.sources import tables
from tidebar.sources.adapters import Tables
from tidebar.streaming import streams

SMALL = "/root/testdata/sf0.001"


def days(start, n):
    return [d.to_pydatetime() for d in pd.date_range(start, periods=n)]


def frame(spark, symbol, start, close, **more):
    n = len(close)
    columns = {"timestamp": days(start, n), "symbol": symbol, "open": close, "high": [c + 1 if c is not None else None for c in close], "low": [c - 1 if c is not None else None for c in close], "close": close, "volume": [100] * n, **more}
    pdf = pd.DataFrame(columns).astype({"open": "float64", "high": "float64", "low": "float64", "close": "float64"})
    df = spark.createDataFrame(pdf)
    nan = lambda c: F.when(~F.isnan(c), F.col(c))
    return df.withColumns({c: nan(c) for c in ("open", "high", "low", "close")})


def test_nth_active_contract_query_has_all_dates(spark):
    t = Tables(spark, SMALL)
    contracts = sorted((r["last_date"], r["symbol"], r["root"]) for r in t.contracts.collect())
    want = set()
    for root, date in t.contract_bars.select("root", F.to_date("timestamp")).distinct().collect():
        alive = [symbol for last, symbol, k in contracts if k == root and last >= date]
        want |= {(root, date, alive[1])} if len(alive) > 1 else set()
    got = [(r["root"], r["date"].date(), r["contract"]) for r in catalog.QUERIES["nth_active_contract"](spark, SMALL).collect()]
    assert len(got) == len(want) and set(got) == want
    assert max(date for _, date, _ in want) > dt.date(1996, 1, 1)


def pair(spark):
    """Two daily contracts with one roll, on 2023-01-06."""
    lin = lambda a, b, n: [float(x) for x in np.linspace(a, b, n)]
    old = frame(spark, "VXG23", "2023-01-01", lin(20.5, 25.5, 10))
    new = frame(spark, "VXH23", "2023-01-06", lin(24.5, 29.5, 10))
    month = F.when(F.col("symbol") == "VXG23", F.lit("2023-02-01").cast("date")).otherwise(F.lit("2023-03-01").cast("date"))
    bars = old.unionByName(new).withColumns({"root": F.lit("VX"), "expiry_month": month, "open_interest": F.col("volume")})
    roll = spark.createDataFrame([("VX", "VXG23", "VXH23", dt.date(2023, 1, 6))], "root string, from_contract string, to_contract string, roll_date date")
    return bars, roll


@pytest.mark.parametrize("lam", [0.0, 0.5, 0.75, 1.0])
def test_split_ratio_factors(spark, lam):
    bars, roll = pair(spark)
    raw = {r["timestamp"]: r for r in continuous.unadjusted(bars, roll).collect()}
    ratio = raw[dt.datetime(2023, 1, 6)]["close"] / bars.where("symbol = 'VXG23' AND timestamp = timestamp'2023-01-06'").first()["close"]
    out = continuous.panama_split(continuous.unadjusted(bars, roll), roll, bars, lam).collect()
    assert len(out) == 15
    for r in out:
        factor = ratio**lam if r["timestamp"] < dt.datetime(2023, 1, 6) else ratio ** (lam - 1)
        assert r["close"] == pytest.approx(raw[r["timestamp"]]["close"] * factor, abs=1e-6)


def test_unadjusted_is_the_contract_in_force(spark):
    bars, roll = pair(spark)
    out = continuous.unadjusted(bars, roll)
    joined = out.join(bars.select(F.col("symbol").alias("underlying_symbol"), "timestamp", F.col("close").alias("own")), ["underlying_symbol", "timestamp"])
    assert joined.where("close = own").count() == out.count() == 15
    assert out.where("timestamp >= timestamp'2023-01-06'").select("underlying_symbol").distinct().collect()[0][0] == "VXH23"


def test_ratio_adjusted_returns_are_raw_inside_a_segment(spark):
    t = Tables(spark, SMALL)
    raw, adjusted = stitched(t), continuous.panama_ratio(stitched(t), vrolls(t), t.contract_bars)
    from pyspark.sql import Window

    w = Window.partitionBy("root", "underlying_symbol").orderBy("timestamp")
    ret = lambda df, n: df.select("root", "timestamp", (F.col("close") / F.lag("close").over(w)).alias(n))
    both = ret(raw, "a").join(ret(adjusted, "b"), ["root", "timestamp"]).where("a IS NOT NULL")
    assert both.count() > 0 and both.where("abs(a / b - 1) > 1e-9").count() == 0


def chain(spark):
    """Three contracts whose volume passes from one to the next."""
    parts = []
    for symbol, start, close, volume in (
        ("VXF23", "2023-01-01", np.linspace(20.5, 22.5, 20), np.linspace(1000, 500, 20)),
        ("VXG23", "2023-01-10", np.linspace(22.0, 24.0, 42), np.r_[np.linspace(600, 1500, 11), np.linspace(1500, 600, 31)]),
        ("VXH23", "2023-02-10", np.linspace(23.5, 25.5, 39), np.r_[np.linspace(700, 1600, 11), np.linspace(1600, 800, 28)]),
    ):
        parts.append(frame(spark, symbol, start, [float(c) for c in close], volume=[int(v) for v in volume]))
    bars = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumns({"root": F.lit("VX"), "open_interest": F.col("volume")})
    bars = symbols.parse_contract(bars).withColumn("expiry_month", F.make_date("parsed_year", "parsed_month", F.lit(1))).drop("parsed_root", "parsed_month", "parsed_year")
    contracts = bars.groupBy("root", "symbol", "expiry_month").agg(F.to_date(F.min("timestamp")).alias("first_date"), F.to_date(F.max("timestamp")).alias("last_date"))
    return bars, contracts


def test_rolls_of_a_chain(spark):
    bars, contracts = chain(spark)
    out = {r["from_contract"]: r for r in rolls.rolls_volume(bars, contracts, ratio=1.5).collect()}
    assert set(out) == {"VXF23", "VXG23"} and out["VXF23"]["to_contract"] == "VXG23"
    assert all(10 <= r["roll_date"].day <= 20 for r in out.values())
    none = rolls.rolls_volume(bars, contracts, ratio=50.0).where("from_contract = 'VXF23'").first()
    assert none["roll_date"] == dt.date(2023, 1, 15) and none["reason"] == "threshold"
    assert rolls.rolls(bars, contracts, "auto").count() == 2


def test_pipeline_order_log_and_disabled_rules(spark):
    bars = frame(spark, "VXG23", "2023-01-01", [float(x) for x in np.linspace(20.5, 25.5, 10)]).withColumn("n", F.dayofmonth("timestamp"))
    bars = bars.withColumns({"close": F.when(F.col("n") == 3, 0.0).otherwise(F.col("close")), "high": F.when(F.col("n") == 4, 18.0).otherwise(F.col("high"))}).drop("n")
    seen = []

    def note(name, run):
        return cleaning.Rule(name, lambda b: (seen.append(name), run(b))[1], ("close", "high", "low"), {"late": 100, "early": 50, "off": 10}[name], name != "off")

    one = lambda b: b.withColumn("close", F.when(F.col("close") == 0, 1.0).otherwise(F.col("close")))
    cleaned, log, summary = cleaning.run_pipeline(bars, [note("late", one), note("early", cleaning.swap_high_low), note("off", cleaning.fix_ohlc)])
    assert seen == ["early", "late"] and cleaned.columns == bars.columns and cleaned.count() == 10
    assert sorted((r["rule"], r["field"], r["new_value"]) for r in log.collect()) == [("early", "high", pytest.approx(21.166666, abs=1e-4)), ("early", "low", 18.0), ("late", "close", 1.0)]
    assert {(r["rule"], r["field"]): r["changes"] for r in summary.collect()} == {("early", "high"): 1, ("early", "low"): 1, ("late", "close"): 1}
    assert cleaned.where("high < low OR close = 0").count() == 0


def test_upsert_is_idempotent(spark):
    old = frame(spark, "AAPL", "2024-01-01", [150.0, 151.0])
    new = frame(spark, "AAPL", "2024-01-02", [152.0, 153.0])
    once = tables.upsert(old, new, ["symbol", "timestamp"])
    twice = tables.upsert(once, new, ["symbol", "timestamp"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) and once.count() == 3
    assert once.where("timestamp = timestamp'2024-01-02'").first()["close"] == 152.0
    assert tables.insert_new(old, new, ["symbol", "timestamp"]).where("close = 151").count() == 1


def test_futures_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Trade Date,Futures,Open,High,Low,Settle,Total Volume,Open Interest\n01/02/2024,F (Jan 2024),14.1,14.5,13.9,14.2,\"1,200\",3400\nbad,F (Jan 2024),1,1,1,1,1,1\n01/03/2024,no label,1,1,1,1,1,1\n")
    (row,) = tables.read_futures_csv(spark, str(tmp_path / "a.csv")).collect()
    assert (row["symbol"], row["settle"], row["volume"], row["timestamp"]) == ("VXF24", 14.2, 1200, dt.datetime(2024, 1, 2))


def test_contract_files_are_named_after_the_contract(spark, tmp_path):
    (tmp_path / "VXF24_daily.csv").write_text("date,open,high,low,close,volume\n2024-01-02,1,2,1,1.5,10\n2024-01-03,1,2,1,,10\n")
    (row,) = tables.read_contract_dir(spark, str(tmp_path)).collect()
    assert (row["symbol"], row["close"], row["volume"]) == ("VXF24", 1.5, 10)


def test_align_fails_on_missing_columns(spark):
    with pytest.raises(ValueError, match="missing columns: open"):
        tables.align(spark.createDataFrame([("A",)], "symbol string"), tables.BAR_SCHEMA)


def test_recursive_indicators_equal_pandas(spark):
    close = [float(x) for x in np.random.default_rng(1).normal(100, 5, 60)]
    bars = frame(spark, "A", "2024-01-01", close).unionByName(frame(spark, "B", "2024-01-01", close[::-1]))
    s = pd.Series(close)
    mean = lambda x, n: x.ewm(span=n, adjust=False).mean()
    ema = [r["ema_12"] for r in indicators.ema(bars, 12).where("symbol = 'A'").orderBy("timestamp").collect()]
    assert ema == pytest.approx(mean(s, 12).tolist())
    macd = mean(s, 12) - mean(s, 26)
    got = indicators.macd(bars).where("symbol = 'A'").orderBy("timestamp").toPandas()
    assert got["macd"].tolist() == pytest.approx(macd.tolist()) and got["macd_histogram"].tolist() == pytest.approx((macd - mean(macd, 9)).tolist())
    metrics = bars.select("symbol", "timestamp", (F.col("close") / 500).alias("volatility"), F.lit(1.0).alias("sharpe"))
    want = (0.15 / (s / 500)).ewm(alpha=0.1, adjust=False).mean().clip(0.1, 3.0)
    assert risk.vol_target(metrics).where("symbol = 'A'").orderBy("timestamp").toPandas()["scaling"].tolist() == pytest.approx(want.tolist())
    long = indicators.indicators_long(bars, ["sma", "ema"])
    assert {r["indicator_name"]: r["n"] for r in long.groupBy("indicator_name").agg(F.count("*").alias("n")).collect()} == {"sma_20": 82, "ema_20": 120}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(1, 100)), min_size=1, max_size=12))
def test_interpolation_equals_pandas(spark, values):
    bars = frame(spark, "A", "2024-01-01", values)
    got = [r["close"] for r in cleaning.interpolate(bars, ["close"]).orderBy("timestamp").collect()]
    want = pd.Series(values, dtype="float64").interpolate().tolist()
    assert [math.nan if x is None else x for x in got] == pytest.approx(want, nan_ok=True)


def test_zero_prices_are_filled_by_method(spark):
    dates = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(30)]
    gone = 10  # no price at all: a holiday
    rows = [("VX", 1, d, 0.0 if i in (gone, 29) else 20.0 + i) for i, d in enumerate(dates)] + [("VX", 2, d, 0.0 if i in (5, gone, 25, 26, 27, 28, 29) else 22.0 + i) for i, d in enumerate(dates)] + [("VX", 3, d, 0.0) for d in dates]
    index = [("VX", d, 0.0 if i == gone else 10.0 + i) for i, d in enumerate(dates)]
    out = cleaning.fill_zero_prices(spark.createDataFrame(rows, "root string, position int, date date, value double"), spark.createDataFrame(index, "root string, date date, value double"))
    got = {(r["position"], r["date"]): (r["method"], r["value"], r["quality"]) for r in out.collect()}
    assert len(got) == 90 and got[1, dates[3]] == ("original", 23.0, 100)
    assert got[2, dates[5]] == ("interpolated", pytest.approx(27.0), 80)
    assert all(got[p, dates[gone]] == ("holiday", 0.0, 100) for p in (1, 2, 3))
    to_front = np.mean([(22.0 + i) / (20.0 + i) for i in range(25) if i not in (5, gone)])
    assert got[2, dates[27]] == ("ratio", pytest.approx(47 * to_front), 75)
    assert got[3, dates[0]] == ("position", pytest.approx(20 * 1.06), 75)
    assert got[1, dates[29]] == ("index_ratio", pytest.approx(39 * np.mean([(20.0 + i) / (10.0 + i) for i in range(29) if i != gone])), 75)
    assert got[3, dates[29]] == ("index", pytest.approx(39 * 1.2), 75)


def test_pipeline_keeps_the_original_when_a_rule_fails(spark):
    bars = frame(spark, "A", "2024-01-01", [1.0, 2.0])
    bad = cleaning.Rule("bad", lambda b: b.withColumn("close", F.col("not_there") + 1), ("close",), 60)
    cleaned, log, summary = cleaning.run_pipeline(bars, [cleaning.RULES["swap_high_low"], bad])
    assert cleaned.columns == bars.columns and sorted(map(tuple, cleaned.collect())) == sorted(map(tuple, bars.collect())) and log.count() == 0
    (row,) = summary.collect()
    assert (row["rule"], row["changes"]) == ("bad", -1) and "not_there" in row["field"]
    with pytest.raises(Exception, match="not_there"):
        cleaning.run_pipeline(bars, [bad], keep_on_error=False)


def test_account_orders_and_trades(spark):
    rows = [
        ('{"AccountID": "A", "OrderID": "7", "Symbol": "VXF24", "Quantity": "3", "LimitPrice": "14.5", "ExecutionTime": "bad", "Time": "2024-01-02T03:04:05Z", "TradeTime": "2024-01-02T03:04:06Z", "Price": 14.25}',),
        ('{"AccountID": null}',), ("no json",), (None,),
    ]
    df = spark.createDataFrame(rows, "payload string")
    (order,) = tables.normalise_account(df, "orders").collect()
    assert (order["order_id"], order["quantity"], order["limit_price"], order["stop_price"], order["side"], order["execution_time"]) == ("7", 3.0, 14.5, 0.0, "", None)
    assert order["timestamp"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    (trade,) = tables.normalise_account(df, "trades").collect()
    assert (trade["price"], trade["commission"], trade["trade_time"]) == (14.25, 0.0, dt.datetime(2024, 1, 2, 3, 4, 6))


def test_exposure_and_costs_by_specs(spark):
    specs = spark.createDataFrame([("ES", 50.0, 1000.0), ("NQ", 20.0, 0.0)], "symbol string, multiplier double, margin double")
    held = spark.createDataFrame([("ES", 30, 10.0), ("ES", -9, 10.0), ("NQ", 5, 2.0), ("XX", 5, 2.0)], "symbol string, quantity long, price double")
    out = {(r["symbol"], r["quantity"]): r for r in risk.exposure(held, specs, 100_000.0, 0.1).collect()}
    r = out["ES", 30]
    assert (r["notional"], r["exposure_pct"], r["margin_used"], r["margin_pct"], r["limited_quantity"]) == (15000.0, 15.0, 30000.0, 30.0, 10.0)
    assert out["ES", -9]["limited_quantity"] == -9.0 and out["NQ", 5]["limited_quantity"] == 5.0 and out["XX", 5]["notional"] is None
    assert {r["limited_quantity"] for r in risk.exposure(held, specs, 100_000.0, 0.1, 4.0).collect()} == {4.0, -4.0}
    trades = spark.createDataFrame([("ES", 10.0, 12.0, -2)], "symbol string, entry double, exit double, quantity long")
    (t,) = risk.trade_costs(trades, specs, rate=0.1, least=0.5, slippage=0.001).collect()
    assert t["pnl"] == -200.0 and t["costs"] == pytest.approx(2 * 0.1 * 10 + 2 * 10 * 50 * 0.001 + 2 * 0.1 * 12 + 2 * 12 * 50 * 0.001)


def test_means_unroll_over_chunks_nulls_and_wild_values(spark, monkeypatch):
    rng = np.random.default_rng(3)
    values = [None if rng.random() < 0.2 else float(x) for x in rng.normal(0, 1, 400) * 10.0 ** rng.integers(-6, 6, 400)]
    bars = frame(spark, "A", "2024-01-01", values)
    for alpha, forgotten in ((0.1, 1e-30), (0.9, 1e-30), (1.0, 1e-30), (0.3, 1e-25)):
        monkeypatch.setattr(indicators, "FORGOTTEN", forgotten)
        got = [r["e"] for r in indicators.ewm(bars, {"e": ("close", alpha)}).orderBy("timestamp").collect()]
        want = pd.Series(values, dtype="float64").ewm(alpha=alpha, adjust=False, ignore_na=True).mean()
        assert [math.nan if x is None else x for x in got] == pytest.approx(want.tolist(), nan_ok=True, rel=1e-9, abs=1e-9)


def test_asof_both_ways(spark):
    d = lambda n: dt.date(2024, 1, n)
    left = spark.createDataFrame([("A", d(n)) for n in (1, 3, 5)], "k string, on date")
    right = spark.createDataFrame([("A", d(2), 2.0), ("A", d(3), 3.0), ("B", d(1), 9.0)], "k string, on date, v double")
    back = {r["on"].day: r["v"] for r in joins.asof(left, right, "on", ["k"], ["v"]).collect()}
    ahead = {r["on"].day: r["v"] for r in joins.asof(left, right, "on", ["k"], ["v"], "forward").collect()}
    assert back == {1: None, 3: 3.0, 5: 3.0} and ahead == {1: 2.0, 3: 3.0, 5: None}


def test_gap_days_and_present_days_make_the_calendar(spark):
    bars = Tables(spark, SMALL).bars
    total = gaps.gaps(bars).groupBy("symbol").agg(F.sum("gap_days").alias("missing"))
    span = bars.groupBy("symbol").agg(F.count_distinct(F.to_date("timestamp")).alias("n"), (F.datediff(F.max("timestamp"), F.min("timestamp")) + 1).alias("span"))
    assert span.join(total, "symbol").where("n + missing <> span").count() == 0


@settings(max_examples=25, deadline=None)
@given(st.dates(dt.date(1990, 1, 1), dt.date(2030, 1, 1)), st.integers(1, 40))
def test_business_days_in_closed_form(spark, start, n):
    end = start + dt.timedelta(n)
    got = spark.range(1).select(business_days_between(F.lit(start), F.lit(end)).alias("n")).first()["n"]
    assert got == sum((start + dt.timedelta(i)).weekday() < 5 for i in range(1, n))


def test_bars_hold_their_invariant(spark):
    assert Tables(spark, SMALL).bars.where("low > least(open, close) OR high < greatest(open, close)").count() == 0


def test_calendar_rules(spark):
    out = {r["month"]: r for r in calendars.vix_settlements(spark, 2023, 2024).collect()}
    assert out[dt.date(2024, 1, 1)]["settlement"] == dt.date(2024, 1, 17) and out[dt.date(2024, 1, 1)]["last_trading_day"] == dt.date(2024, 1, 16)
    assert out[dt.date(2024, 2, 1)]["settlement"] == dt.date(2024, 2, 14)
    names = spark.createDataFrame([("@ES=102XC_d",), ("ESH24",)], "name string")
    rows = symbols.parse_continuous(names).collect()
    assert tuple(rows[0])[1:] == ("ES", 1, 2, "C", "d") and rows[1]["position"] is None


def test_validation_counts_rules_not_rows(spark):
    bars = frame(spark, "A", "2024-01-01", [1.0, -1.0, None]).withColumn("volume", F.lit(0))
    failures = quality.validate(bars, quality.BAR_RULES, ["symbol", "timestamp"])
    assert {r["rule"]: r["n"] for r in failures.groupBy("rule").agg(F.count("*").alias("n")).collect()} == {"positive_close": 1, "volume_not_zero": 3}
    assert '"close":-1.0' in failures.where("rule = 'positive_close'").first()["record"]


# streams --------------------------------------------------------------------------------------------------------------


def ticks(spark, path, batches):
    """A stream that gets one file of ticks a batch."""
    schema = "symbol string, timestamp timestamp, id long, open double, high double, low double, close double, volume long"
    for n, rows in enumerate(batches):
        spark.createDataFrame([(s, t, i, c, c, c, c, 1) for s, t, i, c in rows], schema).coalesce(1).write.mode("append").parquet(f"{path}/in/{n}")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    return stream


AT = dt.datetime(2024, 1, 1, 10)


def at(minutes):
    return AT + dt.timedelta(minutes=minutes)


def test_stream_bars_drop_late_rows(spark, tmp_path):
    stream = ticks(spark, tmp_path, [[("A", at(1), 1, 1.0), ("A", at(2), 2, 3.0)], [("A", at(60), 3, 5.0)], [("A", at(61), 6, 4.0)], [("A", at(3), 4, 99.0), ("A", at(120), 5, 6.0)]])
    out = streams.drained(streams.stream_bars(stream), f"{tmp_path}/c", f"{tmp_path}/o").orderBy("timestamp").collect()
    assert [(r["timestamp"], r["open"], r["high"], r["close"], r["volume"]) for r in out] == [(at(0), 1.0, 3.0, 3.0, 2), (at(60), 5.0, 5.0, 4.0, 2)]


def test_stream_upsert_lets_corrections_win(spark, tmp_path):
    stream = ticks(spark, tmp_path, [[("A", at(1), 1, 1.0), ("B", at(1), 2, 2.0)], [("A", at(1), 3, 9.0)]])
    for _ in range(2):
        streams.stream_upsert(stream, ["symbol", "timestamp"], f"{tmp_path}/state", f"{tmp_path}/c", ["id"]).awaitTermination()
    assert {r["symbol"]: r["close"] for r in streams.latest_state(spark, f"{tmp_path}/state").collect()} == {"A": 9.0, "B": 2.0}


def test_state_is_rewritten_by_the_buckets_that_a_batch_touches(spark, tmp_path):
    first = [[(f"S{i}", at(i % 50), i, float(i)) for i in range(200)]]
    stream = ticks(spark, tmp_path, first + [[("S1", at(1), 1000 + n, 100.0 + n)] for n in range(4)])
    streams.stream_upsert(stream, ["symbol"], f"{tmp_path}/state", f"{tmp_path}/c", ["id"]).awaitTermination()
    out = {r["symbol"]: r["close"] for r in streams.latest_state(spark, f"{tmp_path}/state").collect()}
    assert len(out) == 200 and out["S1"] == 103.0 and out["S7"] == 7.0
    there = [b.name for b in (tmp_path / "state").glob("_version=*/_bucket=*")]
    versions = sorted(there.count(b) for b in set(there))
    assert versions[-1] == 2 and versions[0] == versions[-2] == 1  # one bucket is touched again, and keeps the version before


def test_stream_dedupe_and_validate(spark, tmp_path):
    stream = ticks(spark, tmp_path, [[("A", at(1), 1, 1.0)], [("A", at(1), 1, 1.0), ("A", at(2), 2, -2.0)]])
    assert streams.drained(streams.stream_dedupe(stream, ["symbol", "id"]), f"{tmp_path}/c1", f"{tmp_path}/o1").count() == 2
    bad = streams.drained(streams.stream_validate(stream, {"positive": ("close > 0", "close")}, ["symbol", "id"]), f"{tmp_path}/c2", f"{tmp_path}/o2").collect()
    assert [tuple(r) for r in bad] == [("A", 2, "positive", "close")]


def test_stream_ema_goes_on_between_batches(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    values = [1.0, 2.0, 4.0, 8.0, 3.0]
    stream = ticks(spark, tmp_path, [[("A", at(i), i, v)] for i, v in enumerate(values)])
    out = streams.drained(streams.stream_ema(stream, 3), f"{tmp_path}/c", f"{tmp_path}/o").orderBy("timestamp").collect()
    assert [r["ema"] for r in out] == pytest.approx(pd.Series(values).ewm(span=3, adjust=False).mean().tolist())


def test_every_contract_gets_an_expected_expiry(spark):
    months = {r["symbol"]: r["expiry_month"] for r in Tables(spark, SMALL).contracts.collect()}
    got = {r["symbol"]: r["expiry"].date() for r in catalog.QUERIES["expected_expiries"](spark, SMALL).collect()}
    assert set(got) == set(months) and max(months.values()).year == 2002
    for symbol, m in months.items():
        wanted = next(d for d in (dt.date(m.year, m.month, 15 + i) for i in range(7)) if d.weekday() == 4) - dt.timedelta(2)
        while wanted.weekday() > 4 or str(wanted) in calendars.HOLIDAYS:
            wanted -= dt.timedelta(1)
        assert got[symbol] == wanted
