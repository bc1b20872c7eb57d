"""Continuous series: stitching contracts by their rolls, adjusting, and verifying.

rolls: root, from_contract, to_contract, roll_date. A roll table has a few
rows for each contract; bars meet it by contract, never by a range of dates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebar.functions.calendars import instant
from tidebar.functions.scalars import by_symbol, day, pct, r
from tidebar.operators.joins import prices_at
from tidebar.operators.rolls import roll_pairs

PRICES = ("open", "high", "low", "close")


def segments(rolls: DataFrame) -> DataFrame:
    """(root, symbol, start, end): when each contract is the series; the first has no start, the last no end."""
    ends = rolls.select("root", F.col("from_contract").alias("symbol"), F.lit(None).cast("date").alias("start"), F.col("roll_date").alias("end"))
    starts = rolls.select("root", F.col("to_contract").alias("symbol"), F.col("roll_date").alias("start"), F.lit(None).cast("date").alias("end"))
    return ends.union(starts).groupBy("root", "symbol").agg(F.max("start").alias("start"), F.max("end").alias("end"))


def position_lives(rolls: DataFrame, positions: int) -> DataFrame:
    """(root, position, symbol, start, end): when each contract is the series at a position (1: the front).

    The series at position p goes on by one contract whenever the front rolls, so that a contract is at p from the roll p places before
    its own to that p - 1 places before. rolls: consecutive contracts, root, from_contract, to_contract, roll_date, expiry_month.
    """
    # the last contract of a root is no roll's source: it follows from its roll's target
    own = F.struct(F.col("from_contract").alias("symbol"), "roll_date", F.lit(0).alias("_last"))
    end = F.struct(F.col("to_contract").alias("symbol"), F.lit(None).cast("date").alias("roll_date"), F.lit(1).alias("_last"))
    last = F.row_number().over(Window.partitionBy("root").orderBy(F.col("expiry_month").desc(), F.col("from_contract").desc())) == 1
    chain = rolls.withColumn("_end", last).select("root", "expiry_month", "from_contract", F.inline(F.when(F.col("_end"), F.array(own, end)).otherwise(F.array(own))))
    w = Window.partitionBy("root").orderBy("expiry_month", "from_contract", "_last")
    spans = [F.struct(F.lit(p).alias("position"), F.lag("roll_date", p).over(w).alias("start"), (F.lag("roll_date", p - 1).over(w) if p > 1 else F.col("roll_date")).alias("end"), (F.row_number().over(w) >= p).alias("_known")) for p in range(1, positions + 1)]
    return chain.select("root", "symbol", F.array(*spans).alias("s")).select("root", "symbol", F.inline("s")).where("_known").select("root", "position", "symbol", "start", "end")


def unadjusted_positions(bars: DataFrame, rolls: DataFrame, positions: int) -> DataFrame:
    """unadjusted() for several positions at once, with the column position; bars are read once."""
    date = day("timestamp")
    inside = (F.col("start").isNull() | (date >= F.col("start"))) & (F.col("end").isNull() | (date < F.col("end")))
    met = bars.join(position_lives(rolls, positions), ["root", "symbol"]).where(inside)
    rank = F.row_number().over(Window.partitionBy("root", "position", "timestamp").orderBy("expiry_month", "symbol"))
    return met.withColumn("_rank", rank).where("_rank = 1").drop("_rank", "start", "end").withColumnRenamed("symbol", "underlying_symbol")


def unadjusted(bars: DataFrame, rolls: DataFrame, terms: bool = False) -> DataFrame:
    """One row for each root and timestamp, of the contract whose segment holds it; the earlier expiry if two do.

    terms: with what the adjustments need, too (see adjustment_terms), by the same join.
    """
    date = day("timestamp")
    inside = (F.col("start").isNull() | (date >= F.col("start"))) & (F.col("end").isNull() | (date < F.col("end")))
    met = bars.join(adjustment_terms(rolls, bars) if terms else segments(rolls), ["root", "symbol"]).where(inside)
    rank = F.row_number().over(Window.partitionBy("root", "timestamp").orderBy("expiry_month", "symbol"))
    return met.withColumn("_rank", rank).where("_rank = 1").drop("_rank", "start", "end").withColumnRenamed("symbol", "underlying_symbol")


def priced(rolls: DataFrame, bars: DataFrame) -> DataFrame:
    """Rolls with from_close and to_close on the roll date (null if either has no bar), as they are if they have them already."""
    if {"from_close", "to_close"} <= set(rolls.columns):
        return rolls
    close = lambda name: bars.select(F.col("symbol").alias(f"{name}_contract"), day("timestamp").alias("roll_date"), F.col("close").alias(f"{name}_close"))
    return rolls.join(close("from"), ["from_contract", "roll_date"], "left").join(close("to"), ["to_contract", "roll_date"], "left")


#: Products of close ratios and sums of differences, up to a contract and after it.
TERMS = ("ratio_before", "ratio_after", "gap_before", "gap_after")


def adjustment_terms(rolls: DataFrame, bars: DataFrame) -> DataFrame:
    """(root, symbol, start, end) as segments(), with TERMS of each contract, in one pass over the priced rolls.

    The first contract of a root is no roll's target: nothing lies before it, everything after.
    """
    w = Window.partitionBy("root").orderBy("roll_date", "from_contract")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("root").orderBy(F.col("roll_date").desc(), F.col("from_contract").desc()).rowsBetween(Window.unboundedPreceding, -1)
    made = priced(rolls, bars).withColumns(
        {"ratio": F.coalesce(F.try_divide("to_close", "from_close"), F.lit(1.0)), "gap": F.coalesce(F.col("to_close") - F.col("from_close"), F.lit(0.0))}
    )
    made = made.withColumns(
        {
            "ratio_before": F.product("ratio").over(upto), "ratio_after": F.coalesce(F.product("ratio").over(later), F.lit(1.0)),
            "gap_before": F.sum("gap").over(upto), "gap_after": F.coalesce(F.sum("gap").over(later), F.lit(0.0)),
        }
    )
    none = lambda kind: F.lit(None).cast(kind)
    to = F.struct(F.col("to_contract").alias("symbol"), F.col("roll_date").alias("start"), none("date").alias("end"), *TERMS, none("double").alias("ratio_all"), none("double").alias("gap_all"))
    every = Window.partitionBy("root")
    made = made.withColumns({"ratio_all": F.product("ratio").over(every), "gap_all": F.sum("gap").over(every)})
    own = F.struct(
        F.col("from_contract").alias("symbol"), none("date").alias("start"), F.col("roll_date").alias("end"), *(none("double").alias(t) for t in TERMS), "ratio_all", "gap_all"
    )
    each = made.select("root", F.inline(F.array(to, own)))
    terms = each.groupBy("root", "symbol").agg(*(F.max(c).alias(c) for c in ("start", "end", *TERMS, "ratio_all", "gap_all")))
    first = F.col("start").isNull()
    return terms.withColumns(
        {
            "ratio_before": F.coalesce("ratio_before", F.lit(1.0)), "gap_before": F.coalesce("gap_before", F.lit(0.0)),
            "ratio_after": F.when(first, F.col("ratio_all")).otherwise(F.col("ratio_after")), "gap_after": F.when(first, F.col("gap_all")).otherwise(F.col("gap_after")),
        }
    ).drop("ratio_all", "gap_all")


def _with_factors(stitched: DataFrame, rolls: DataFrame | None, bars: DataFrame | None) -> DataFrame:
    """A series with TERMS: its own, or those of rolls and bars."""
    if set(TERMS) <= set(stitched.columns):
        return stitched
    known = adjustment_terms(rolls, bars).drop("start", "end").withColumnRenamed("symbol", "underlying_symbol")
    return stitched.join(known, ["root", "underlying_symbol"], "left").withColumns({t: F.coalesce(t, F.lit(1.0 if t.startswith("ratio") else 0.0)) for t in TERMS})


def _adjusted(df: DataFrame, change: Callable, factor) -> DataFrame:
    return df.withColumn("adjustment_factor", factor).withColumns({c: change(F.col(c), factor) for c in PRICES}).drop("ratio_before", "ratio_after", "gap_before", "gap_after")


def panama_ratio(stitched: DataFrame, rolls: DataFrame | None = None, bars: DataFrame | None = None) -> DataFrame:
    """Forward adjustment to the first contract: prices over the product of the ratios of the rolls so far."""
    return _adjusted(_with_factors(stitched, rolls, bars), lambda c, f: c / f, F.col("ratio_before"))


def panama_additive(stitched: DataFrame, rolls: DataFrame | None = None, bars: DataFrame | None = None) -> DataFrame:
    """Forward adjustment by the sum of from_close - to_close of the rolls so far."""
    return _adjusted(_with_factors(stitched, rolls, bars), lambda c, f: c + f, -F.col("gap_before"))


def panama_split(stitched: DataFrame, rolls: DataFrame | None = None, bars: DataFrame | None = None, lam: float = 0.5) -> DataFrame:
    """Each roll's ratio shared: the older side times r^lam, the newer times r^(lam - 1); 1 adjusts back, 0 forward."""
    return _adjusted(_with_factors(stitched, rolls, bars), lambda c, f: c * f, F.pow(F.col("ratio_after"), F.lit(lam)) * F.pow(F.col("ratio_before"), F.lit(lam - 1)))


def back_adjust_constant(stitched: DataFrame, rolls: DataFrame | None = None, bars: DataFrame | None = None) -> DataFrame:
    """Back adjustment: each contract's prices plus the differences of all later rolls."""
    return _adjusted(_with_factors(stitched, rolls, bars), lambda c, f: c + f, F.col("gap_after"))


def back_adjust_at(bars: DataFrame, calendar: DataFrame, position: int = 1, roll_time: str = "23:59:59", zone: str = "UTC", adjust: bool = True) -> DataFrame:
    """Back adjustment of the series at a position (1: the front), whose rolls are at a time of day of an exchange.

    calendar: root, symbol, expiry_month, roll_date, one row a contract. The series goes on by one contract at roll_time
    of zone on each roll date of the front (see instant() for hours that a clock skips or repeats). A contract's bars count after the
    roll into it, up to and at the roll out of it. A roll's gap is the front's close less the back's, both as of
    the instant (the back's first one after it, if it has none before; no gap without both), and each contract's prices are lowered by
    the gaps of its own and all later rolls. Bars meet the rolls of their contract, never one another.
    """
    rolls = roll_pairs(calendar, position).withColumn("instant", instant("roll_date", roll_time, zone))
    priced_rolls = prices_at(rolls, bars)
    gap = F.coalesce(F.col("front_price") - F.col("back_price"), F.lit(0.0)) if adjust else F.lit(0.0)
    later = Window.partitionBy("root").orderBy(F.col("instant").desc(), F.col("from_contract").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = priced_rolls.withColumn("gap", gap).withColumn("gaps", F.sum("gap").over(later))
    none = lambda kind: F.lit(None).cast(kind)
    out = F.struct(F.col("from_contract").alias("symbol"), none("timestamp").alias("start"), F.col("instant").alias("end"), F.col("to_contract").alias("next_contract"), F.col("gaps").alias("shift"))
    into = F.struct(F.col("to_contract").alias("symbol"), F.col("instant").alias("start"), none("timestamp").alias("end"), none("string").alias("next_contract"), none("double").alias("shift"))
    lives = summed.select("root", F.inline(F.array(out, into))).groupBy("root", "symbol").agg(*(F.max(c).alias(c) for c in ("start", "end", "next_contract", "shift")))
    met = bars.join(lives, ["root", "symbol"]).where((F.col("start").isNull() | (F.col("timestamp") > F.col("start"))) & (F.col("end").isNull() | (F.col("timestamp") <= F.col("end"))))
    factor = -F.coalesce("shift", F.lit(0.0))
    return met.withColumn("adjustment_factor", factor).select("root", "timestamp", F.col("symbol").alias("underlying_symbol"), "next_contract", *((F.col(c) + factor).alias(c) for c in PRICES), "volume", "adjustment_factor")


def back_adjust_reverse(stitched: DataFrame, rolls: DataFrame | None = None, bars: DataFrame | None = None) -> DataFrame:
    """As back_adjust_constant, beside the raw prices: adj_* columns and adj_factor."""
    df = _with_factors(stitched, rolls, bars)
    return df.withColumns({f"adj_{c}": F.col(c) + F.col("gap_after") for c in PRICES} | {"adj_factor": F.col("gap_after")}).drop("ratio_before", "ratio_after", "gap_before", "gap_after")


#: The adjustment that the last letter of a continuous name asks for; callers may add to it.
ADJUSTMENTS: dict[str, Callable[..., DataFrame]] = {
    "N": lambda stitched, rolls, bars: stitched,
    "R": panama_ratio,
    "A": panama_additive,
    "S": panama_split,
    "C": back_adjust_constant,
}


def build(name: str, bars: DataFrame, rolls: DataFrame) -> DataFrame:
    """The continuous series that a name like @ES=102XC asks for."""
    letter = name.split("_")[0][-1]
    return ADJUSTMENTS[letter](unadjusted(bars, rolls, letter != "N"), rolls, bars)


def continuous_nth(bars: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mapped contracts with their bars: valid settle or close, no volume as 0; dates without a bar stay as null rows."""
    rows = bars.withColumn("date", day("timestamp")).select("symbol", "date", *PRICES, "volume", "open_interest")
    joined = mapping.join(rows, ["symbol", "date"], "left")
    return joined.withColumns(
        {"settle": F.when(F.col("close") > 0, F.col("close")), "volume": F.coalesce("volume", F.lit(0)).cast("long"), "open_interest": F.coalesce("open_interest", F.lit(0)).cast("long")}
    ).withColumnRenamed("symbol", "underlying_symbol")


def append_new(existing: DataFrame, built: DataFrame, key: str = "root", force: bool = False) -> DataFrame:
    """Stored rows and those built rows that are newer; all built rows if forced."""
    if force:
        return built
    newest = existing.groupBy(key).agg(F.max("timestamp").alias("_newest"))
    fresh = built.join(newest, key, "left").where(F.col("_newest").isNull() | (F.col("timestamp") > F.col("_newest"))).drop("_newest")
    return existing.unionByName(fresh)


def roll_analysis(cont: DataFrame, n: int = 5) -> DataFrame:
    """Rolls with the ratio of closes over the roll, the return of the n rows before and after, and the yearly volatility of the whole series in percent."""
    w = by_symbol(key="root")
    close = F.col("close")
    moved = cont.withColumn("_return", F.try_divide(close, F.lag("close").over(w)) - 1)
    out = moved.select(
        "root", "timestamp", F.lag("underlying_symbol").over(w).alias("from_contract"), F.col("underlying_symbol").alias("to_contract"),
        r(F.try_divide(close, F.lag(close).over(w))).alias("factor"),
        r(F.try_divide(F.lag(close, 1).over(w), F.lag(close, n + 1).over(w)) - 1).alias("return_before"),
        r(F.try_divide(F.lead(close, n).over(w), close) - 1).alias("return_after"),
        r(F.stddev_samp("_return").over(Window.partitionBy("root")) * F.sqrt(F.lit(252.0)) * 100, 4).alias("volatility"),
    )
    return out.where("from_contract <> to_contract")


def rollover_days(cont: DataFrame, bars: DataFrame, active: DataFrame) -> DataFrame:
    """Continuous rows with the expected contract, its close, and whether the expected contract has just changed."""
    expected = active.withColumn("_before", F.lag("active_contract").over(Window.partitionBy("root").orderBy("date")))
    close = bars.select(F.col("symbol").alias("active_contract"), day("timestamp").alias("date"), F.col("close").alias("contract_close"))
    out = cont.withColumn("date", day("timestamp")).join(expected, ["root", "date"], "left").join(close, ["active_contract", "date"], "left")
    kind = F.when(F.col("_before").isNotNull() & (F.col("_before") != F.col("active_contract")), "ROLLOVER").otherwise("NORMAL")
    return out.select("root", "timestamp", "underlying_symbol", "active_contract", "close", "contract_close", kind.alias("day_type"))


def consistency_check(cont: DataFrame, bars: DataFrame, active: DataFrame, tolerance: float = 0.01) -> DataFrame:
    days = rollover_days(cont, bars, active)
    difference = F.abs(F.col("close") - F.col("contract_close"))
    status = F.when(F.try_divide(difference, F.col("contract_close")) > tolerance, "WARNING").when(F.col("contract_close").isNull(), "MISSING").otherwise("OK")
    return days.select("root", "timestamp", r(difference).alias("difference"), r(pct(difference, F.col("contract_close"))).alias("difference_pct"), status.alias("status"))


def verify_rollovers(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Roll dates that match, are unexpected, or are missing; both: root, date."""
    a, e = actual.select("root", "date", F.lit(True).alias("_a")).distinct(), expected.select("root", "date", F.lit(True).alias("_e")).distinct()
    status = F.when(F.col("_a").isNotNull() & F.col("_e").isNotNull(), "MATCH").when(F.col("_a").isNotNull(), "UNEXPECTED").otherwise("MISSING")
    return a.join(e, ["root", "date"], "full_outer").select("root", "date", status.alias("status"))


def verify_continuous(cont: DataFrame, bars: DataFrame, expected: DataFrame, settlements: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """A status for each row of continuous series, of one position or (with a column position in cont and expected) of several in one pass.

    expected: root, date, symbol that should be in force; settlements: root, date of rolls. The contract before is the
    last of the position that was not null.
    """
    key = ["root", "position"] if "position" in cont.columns else ["root"]
    close = bars.select(F.col("symbol").alias("underlying_symbol"), day("timestamp").alias("date"), F.col("close").alias("contract_close"))
    want = expected.select(*key, "date", F.col("symbol").alias("expected_symbol"))
    due = settlements.select("root", "date", F.lit(True).alias("_due")).distinct()
    before = F.last("underlying_symbol", ignorenulls=True).over(Window.partitionBy(*key).orderBy("date").rowsBetween(Window.unboundedPreceding, -1))
    df = cont.withColumn("date", day("timestamp")).withColumn("_before", before)
    df = df.join(want, [*key, "date"], "left").join(close, ["underlying_symbol", "date"], "left").join(due, ["root", "date"], "left")
    rolled = F.col("_before").isNotNull() & (F.col("_before") != F.col("underlying_symbol"))
    off = F.abs(F.try_divide(F.col("close") - F.col("contract_close"), F.col("contract_close")))
    on_day = F.col("_due").isNotNull()
    status = (
        F.when(F.col("underlying_symbol").isNull(), "MISSING_UNDERLYING")
        .when(F.col("close").isNull(), "MISSING_CONTINUOUS_PRICE")
        .when(F.col("contract_close").isNull(), "MISSING_CONTRACT_PRICE")
        .when(rolled & (off > tolerance), "ROLLOVER_PRICE_MISMATCH")
        .when(rolled & on_day, "ROLLOVER_ON_SETTLEMENT_DATE")
        .when(rolled, "ROLLOVER_NOT_ON_SETTLEMENT_DATE")
        .when(on_day & F.col("_before").isNotNull(), "MISSED_ROLLOVER")
        .when(F.col("expected_symbol").isNotNull() & (F.col("expected_symbol") != F.col("underlying_symbol")), "UNDERLYING_MISMATCH")
        .when(off > 10 * tolerance, "LARGE_PRICE_DIFF")
        .when(off > tolerance, "SMALL_PRICE_DIFF")
        .otherwise("OK")
    )
    return df.select(*key, "timestamp", "underlying_symbol", "expected_symbol", status.alias("status"))
