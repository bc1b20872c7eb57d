"""Back adjustment at an instant, prices as of rolls, active contracts, and verification, on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidebar.functions import calendars
from tidebar.functions.calendars import instant
from tidebar.operators import continuous, joins, rolls
from tidebar.plans import catalog



def at(text):
    return dt.datetime.fromisoformat(text)


def test_instants_of_a_zone_over_clock_changes(spark):
    days = ["2024-01-05", "2024-03-08", "2024-03-10", "2024-03-11", "2024-11-03", "2024-11-04"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    got = {str(r[0]): r[1] for r in df.select("d", instant("d", "16:15:00", "America/New_York")).collect()}
    assert got["2024-01-05"] == at("2024-01-05 21:15:00") and got["2024-03-08"] == at("2024-03-08 21:15:00")
    assert got["2024-03-10"] == at("2024-03-10 20:15:00") and got["2024-11-04"] == at("2024-11-04 21:15:00")
    early = {str(r[0]): r[1] for r in df.select("d", instant("d", "02:30:00", "America/New_York")).collect()}
    assert early["2024-03-10"] == at("2024-03-10 07:30:00")  # skipped: an hour later, 03:30 in summer time
    repeated = {str(r[0]): r[1] for r in df.select("d", instant("d", "01:30:00", "America/New_York")).collect()}
    assert repeated["2024-11-03"] == at("2024-11-03 05:30:00")  # the first of two, in summer time


def intraday(spark, rows):
    each = [("R", s, at(ts), c, c + 1, c - 1, c, 1) for s, ts, c in rows]
    return spark.createDataFrame(each, "root string, symbol string, timestamp timestamp, open double, high double, low double, close double, volume long")


CALENDAR = "root string, symbol string, expiry_month date, roll_date date"


def calendar(spark):
    day = dt.date.fromisoformat
    return spark.createDataFrame([("R", "RH24", day("2024-03-01"), day("2024-03-08")), ("R", "RJ24", day("2024-04-01"), day("2024-03-11")), ("R", "RK24", day("2024-05-01"), day("2024-04-20"))], CALENDAR)


def test_back_adjustment_at_an_instant_over_a_clock_change(spark):
    """Rolls at 16:15 in New York: at 21:15 UTC on 8 March, at 20:15 on the 11th."""
    rows = [
        ("RH24", "2024-03-08 21:10:00", 100.0), ("RH24", "2024-03-08 21:15:00", 101.0), ("RH24", "2024-03-08 21:20:00", 999.0),
        ("RJ24", "2024-03-08 21:00:00", 110.0), ("RJ24", "2024-03-08 21:15:00", 111.0), ("RJ24", "2024-03-08 21:20:00", 112.0), ("RJ24", "2024-03-11 20:15:00", 113.0), ("RJ24", "2024-03-11 20:20:00", 999.0),
        ("RK24", "2024-03-11 20:30:00", 130.0), ("RK24", "2024-04-25 00:00:00", 131.0),
    ]
    bars = intraday(spark, rows)
    out = continuous.back_adjust_at(bars, calendar(spark), 1, "16:15:00", "America/New_York")
    got = [(str(r["timestamp"])[5:16], r["underlying_symbol"], r["next_contract"], r["close"], r["adjustment_factor"]) for r in out.orderBy("timestamp").collect()]
    # the second roll's back has nothing before it: its first bar after counts; gaps are 101 - 111 and 113 - 130
    assert got == [
        ("03-08 21:10", "RH24", "RJ24", 127.0, 27.0), ("03-08 21:15", "RH24", "RJ24", 128.0, 27.0), ("03-08 21:20", "RJ24", "RK24", 129.0, 17.0),
        ("03-11 20:15", "RJ24", "RK24", 130.0, 17.0), ("03-11 20:30", "RK24", None, 130.0, 0.0), ("04-25 00:00", "RK24", None, 131.0, 0.0),
    ]
    second = continuous.back_adjust_at(bars, calendar(spark), 2, "16:15:00", "America/New_York").orderBy("timestamp", "underlying_symbol").collect()
    # the second position holds the April contract until the front rolls, on 8 March, then the next one; no gap but of one roll
    assert [(r["underlying_symbol"], r["close"]) for r in second] == [("RJ24", 129.0), ("RJ24", 130.0), ("RK24", 130.0), ("RK24", 131.0)]
    plain = continuous.back_adjust_at(bars, calendar(spark), 1, "16:15:00", "America/New_York", adjust=False)
    assert {r["adjustment_factor"] for r in plain.collect()} == {0.0}
    utc = continuous.back_adjust_at(bars, calendar(spark), 1)  # the end of the day in UTC
    assert utc.where("timestamp = timestamp'2024-03-08 21:20:00'").first()["underlying_symbol"] == "RH24"


def test_prices_at_rolls_without_bars(spark):
    rolls = spark.createDataFrame([("R", "RH24", "RX99", at("2024-03-08 21:15:00")), ("R", "RX98", "RX99", None)], "root string, from_contract string, to_contract string, instant timestamp")
    bars = intraday(spark, [("RH24", "2024-03-01 00:00:00", 5.0)])
    got = {r["from_contract"]: (r["front_price"], r["back_price"]) for r in joins.prices_at(rolls, bars).collect()}
    assert got == {"RH24": (5.0, None), "RX98": (None, None)}


def test_bars_are_not_shuffled_for_prices_at_rolls(spark):
    bars = intraday(spark, [("RH24", "2024-03-01 00:00:00", 5.0)])
    rolls = spark.createDataFrame([("R", "RH24", "RJ24", at("2024-03-08 21:15:00"))], "root string, from_contract string, to_contract string, instant timestamp")
    plan = joins.prices_at(rolls, bars).join(F.broadcast(rolls.select("root")), "root")._jdf.queryExecution().toString()
    assert "Window" not in plan and "partial_max_by" in plan


def test_active_contract_by_mean_volume_over_sessions(spark):
    """March expires on Friday the 15th: volumes count from the seventh session before it, Wednesday the 6th, on."""
    day = lambda n: dt.datetime(2024, 3, n)
    rows = [("R", "RH24", day(n), 10) for n in range(1, 16)] + [("R", "RM24", day(n), 100 if n >= 8 else 1) for n in range(1, 23)]
    rows = [r for r in rows if r[2].weekday() < 5 and r[2] != day(12)]  # no bars on the 12th, which is a session all the same
    bars = spark.createDataFrame(rows, "root string, symbol string, timestamp timestamp, volume long")
    contracts = spark.createDataFrame([("R", "RH24", dt.date(2024, 3, 15)), ("R", "RM24", dt.date(2024, 6, 21))], "root string, symbol string, last_date date")
    sessions = calendars.business_calendar(spark, "2024-01-01", "2024-12-31")
    got = {r["date"].day: r for r in rolls.near_expiry(bars, contracts, sessions).collect()}
    assert [n for n, r in sorted(got.items()) if r["near"]] == [6, 7, 8, 11, 13, 14, 15]
    assert got[5]["second_volume"] is None and got[6]["nearest_volume"] == 10 and got[6]["second_volume"] == 1
    # on the 8th the window is the 28th of February to the 8th: one of six bars is large
    assert got[8]["second_volume"] == pytest.approx((100 + 5) / 6) and got[8]["active_contract"] == "RM24" and got[7]["active_contract"] == "RH24"
    assert got[14]["second_volume"] == pytest.approx((100 * 4 + 3) / 7)  # the 5th to the 14th, without the 12th
    assert got[18]["nearest"] == "RM24" and got[18]["second"] is None
    active = rolls.active_by_volume(bars, contracts, sessions)
    assert [(r["roll_date"].day, r["from_contract"], r["to_contract"]) for r in rolls.rolls_of(active).collect()] == [(8, "RH24", "RM24")]


RULES = [("W", "weekday", 4, 3, None), ("Q", "weekday", 0, 5, None), ("D", "before_day", None, 3, 25), ("E", "before_day", None, 9, 2), ("L", "before_last", None, 2, None), ("V", "vx", None, None, None)]


def test_expiry_rules(spark):
    """Good Friday of 2024, 29 March, and New Year of 2024 are no trading days."""
    sessions = calendars.business_calendar(spark, "2022-12-01", "2025-03-31")
    months = [dt.date(2024, m, 1) for m in (1, 2, 3, 4)] + [dt.date(2023, 5, 1)]
    contracts = spark.createDataFrame([(r, f"{r}{m:%y%m}", m) for r in "WQDELVX" for m in months], "root string, symbol string, month date")
    got = {r["symbol"]: r["expiry"].isoformat() for r in calendars.rule_expiry(contracts, spark.createDataFrame(RULES, calendars.RULES), sessions).collect()}
    assert got["W2403"] == "2024-03-15" and got["Q2404"] == "2024-04-29" and got["Q2402"] == "2024-02-15"  # February has four Mondays
    assert got["Q2401"] == "2024-01-15"  # of five Mondays two are holidays
    assert got["D2403"] == "2024-03-20" and got["D2402"] == "2024-02-21"  # Saturday the 25th, and Sunday: Friday counts first
    assert got["E2403"] == "2024-03-15"  # nine days before the 2nd are more than five days before the month
    assert got["L2403"] == "2024-03-26" and got["L2401"] == "2024-01-29"
    # VX of February 2024: 30 days before Friday 15 March; of May 2023: before Friday 16 June
    assert got["V2402"] == "2024-02-14" and got["V2305"] == "2023-05-17" and got["X2403"] == "2024-03-15"


def test_positions_of_a_series(spark):
    day = dt.date.fromisoformat
    rolls_ = spark.createDataFrame([("R", "A", "B", day("2024-01-10"), day("2024-01-01")), ("R", "B", "C", day("2024-02-10"), day("2024-02-01"))], "root string, from_contract string, to_contract string, roll_date date, expiry_month date")
    got = sorted((r["position"], r["symbol"], r["start"] and r["start"].isoformat()[5:], r["end"] and r["end"].isoformat()[5:]) for r in continuous.position_lives(rolls_, 3).collect())
    assert got == [(1, "A", None, "01-10"), (1, "B", "01-10", "02-10"), (1, "C", "02-10", None), (2, "B", None, "01-10"), (2, "C", "01-10", "02-10"), (3, "C", None, "01-10")]
    months = {"A": "2024-01-01", "B": "2024-02-01", "C": "2024-03-01"}
    bars = spark.createDataFrame([("R", s, dt.datetime(2024, 1, n), day(months[s]), float(n)) for s in "ABC" for n in (8, 9, 10, 11)], "root string, symbol string, timestamp timestamp, expiry_month date, close double")
    cont = continuous.unadjusted_positions(bars, rolls_, 2)
    assert sorted((r["position"], r["timestamp"].day, r["underlying_symbol"]) for r in cont.collect()) == [(1, 8, "A"), (1, 9, "A"), (1, 10, "B"), (1, 11, "B"), (2, 8, "B"), (2, 9, "B"), (2, 10, "C"), (2, 11, "C")]
    want = cont.select("root", "position", F.to_date("timestamp").alias("date"), F.when((F.col("position") == 2) & (F.dayofmonth("timestamp") == 9), "A").otherwise(F.col("underlying_symbol")).alias("symbol"))
    wrong = cont.withColumn("close", F.when((F.col("position") == 2) & (F.dayofmonth("timestamp") == 11), 12.0).otherwise(F.col("close")))
    status = {(r["position"], r["timestamp"].day): r["status"] for r in continuous.verify_continuous(wrong, bars, want, rolls_.select("root", F.col("roll_date").alias("date"))).collect()}
    assert status == {(1, 8): "OK", (1, 9): "OK", (1, 10): "ROLLOVER_ON_SETTLEMENT_DATE", (1, 11): "OK", (2, 8): "OK", (2, 9): "UNDERLYING_MISMATCH", (2, 10): "ROLLOVER_ON_SETTLEMENT_DATE", (2, 11): "LARGE_PRICE_DIFF"}


def test_verification_makes_the_bars_once(spark):
    plan = catalog.QUERIES["verify_continuous"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and plan.count("FileScan parquet") <= 9
