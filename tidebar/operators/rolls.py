"""Roll detection: all contracts of all roots at once, as joins of consecutive contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebar.functions.calendars import on_or_before, third_friday, with_ordinal
from tidebar.functions.scalars import day
from tidebar.operators.windows import preferred_roll_dedup



def pairs(contracts: DataFrame) -> DataFrame:
    """Each contract with the next of its root; contracts: root, symbol, expiry_month, last_date."""
    w = Window.partitionBy("root").orderBy("expiry_month")
    return contracts.select("root", F.col("symbol").alias("from_contract"), F.lead("symbol").over(w).alias("to_contract"), "expiry_month", "last_date").where("to_contract IS NOT NULL")


#: What a pair of consecutive contracts is known by.
PAIR = ("root", "from_contract", "to_contract", "expiry_month", "last_date")


def side_by_side(bars: DataFrame, contracts: DataFrame, measure: str) -> DataFrame:
    """Each pair and date with the measure and the close of both contracts: own, after, from_close, to_close.

    Each bar goes to the pair that its contract opens and to that which it ends, and the two meet in one aggregation,
    so that bars are read once; all that follows by pair finds its rows in place.
    """
    side = lambda name, n: F.struct(F.col(name).alias("symbol"), F.lit(n).alias("side"))
    sides = pairs(contracts).select(*PAIR, F.explode(F.array(side("from_contract", 0), side("to_contract", 1))).alias("s")).select(*PAIR, "s.*")
    rows = bars.select("symbol", day("timestamp").alias("date"), F.col(measure).alias("m"), "close").join(sides, "symbol").repartition(*PAIR)
    of = lambda c, n: F.max(F.when(F.col("side") == n, F.col(c)))
    return rows.groupBy(*PAIR, "date").agg(of("m", 0).alias("own"), of("m", 1).alias("after"), of("close", 0).alias("from_close"), of("close", 1).alias("to_close"))


def crossover(bars: DataFrame, contracts: DataFrame, measure: str, ratio: float, threshold: int, offset: int, closes: bool = False) -> DataFrame:
    """The roll is on the first common day on which the next contract's measure reaches ratio times the contract's own
    (and offset days later), else threshold days (10 at most) before the contract's last one.

    closes: with from_close and to_close of the roll date, too (null if either has no bar).
    """
    by_pair = Window.partitionBy(*PAIR)
    crossed = F.min(F.when(F.col("after") >= ratio * F.col("own"), F.col("date"))).over(by_pair)
    roll_date = F.coalesce(F.date_add("crossed", offset), F.date_sub("last_date", min(threshold, 10)))
    rows = side_by_side(bars, contracts, measure).withColumn("crossed", crossed).withColumn("roll_date", roll_date)
    there = lambda c: F.max(F.when(F.col("date") == F.col("roll_date"), F.col(c))).alias(c)
    found = rows.groupBy(*PAIR).agg(F.max("roll_date").alias("roll_date"), F.max("crossed").alias("crossed"), F.count("own").alias("_own"), there("from_close"), there("to_close"))
    out = found.where("_own > 0").select(
        "root", "from_contract", "to_contract", "expiry_month", "roll_date", F.date_add("last_date", 1).alias("expiration_date"),
        F.when(F.col("crossed").isNotNull(), "crossover").otherwise("threshold").alias("reason"), "from_close", "to_close",
    )
    return out if closes else out.drop("from_close", "to_close")


def rolls_volume(bars: DataFrame, contracts: DataFrame, ratio: float = 2.0, threshold: int = 5, offset: int = 0, closes: bool = False) -> DataFrame:
    return crossover(bars, contracts, "volume", ratio, threshold, offset, closes)


def rolls_open_interest(bars: DataFrame, contracts: DataFrame, ratio: float = 1.5, threshold: int = 5, offset: int = 0, closes: bool = False) -> DataFrame:
    return crossover(bars, contracts, "open_interest", ratio, threshold, offset, closes)


def rolls_calendar(contracts: DataFrame, threshold: int = 5) -> DataFrame:
    """Threshold days before the third Friday of the expiry month, moved back off weekends."""
    raw = F.date_sub(third_friday(F.col("expiry_month")), threshold)
    off = F.when(F.weekday(raw) >= 5, F.date_sub(raw, F.weekday(raw) - 4)).otherwise(raw)
    return pairs(contracts).select("root", "from_contract", "to_contract", "expiry_month", off.alias("roll_date"))


def rolls(bars: DataFrame, contracts: DataFrame, method: str = "auto") -> DataFrame:
    """By volume, open interest or calendar; auto takes the first whose data is there (one aggregate tells)."""
    if method == "auto":
        has = bars.agg(*(F.coalesce(F.max(F.col(c)) > 0, F.lit(False)).alias(c) for c in ("volume", "open_interest"))).first()
        method = "volume" if has["volume"] else "open_interest" if has["open_interest"] else "calendar"
    return {
        "volume": lambda: rolls_volume(bars, contracts),
        "open_interest": lambda: rolls_open_interest(bars, contracts),
        "calendar": lambda: rolls_calendar(contracts),
    }[method]()


def rolls_last_window(bars: DataFrame, contracts: DataFrame, n: int = 5) -> DataFrame:
    """Within the contract's last n sessions, the latest on which the next one trades more (none: null)."""
    w = Window.partitionBy("symbol").orderBy(F.col("timestamp").desc())
    late = bars.withColumn("_left", F.row_number().over(w)).where(F.col("_left") <= n)
    own = late.select(F.col("symbol").alias("from_contract"), day("timestamp").alias("date"), F.col("volume").alias("own"))
    after = bars.select(F.col("symbol").alias("to_contract"), day("timestamp").alias("date"), F.col("volume").alias("after"))
    met = pairs(contracts).join(own, "from_contract").join(after, ["to_contract", "date"], "left")
    more = F.coalesce("after", F.lit(0)) > F.coalesce("own", F.lit(0))
    return met.groupBy("root", "from_contract", "to_contract").agg(F.max(F.when(more, F.col("date"))).alias("roll_date"))


def roll_pairs(calendar: DataFrame, position: int) -> DataFrame:
    """(roll date, from, to) of the series at a position: on each roll it goes on by one contract; calendar: root, symbol, roll_date, expiry_month."""
    w = Window.partitionBy("root").orderBy("expiry_month")
    out = calendar.select("root", "roll_date", F.lead("symbol", position - 1).over(w).alias("from_contract"), F.lead("symbol", position).over(w).alias("to_contract"))
    return out.where("from_contract IS NOT NULL AND to_contract IS NOT NULL")


def rollovers_in_range(roll_dates: DataFrame, start: str, end: str, preferred: str = "volume", bars: DataFrame | None = None) -> DataFrame:
    """Rolls of the range, the last before it and the first after it, one a contract and date; with bars: from_price and to_price, the closes of both contracts on the day.

    The few rolls go to the bars, which are not shuffled but for what they add up to.
    """
    ordered = preferred_roll_dedup(roll_dates, preferred)
    a, b = F.lit(start).cast("date"), F.lit(end).cast("date")
    w = Window.partitionBy("root")
    before, after = F.max(F.when(F.col("roll_date") < a, F.col("roll_date"))).over(w), F.min(F.when(F.col("roll_date") > b, F.col("roll_date"))).over(w)
    found = ordered.withColumns({"_before": before, "_after": after}).where(F.col("roll_date").between(a, b) | (F.col("roll_date") == F.col("_before")) | (F.col("roll_date") == F.col("_after"))).drop("_before", "_after")
    if bars is None:
        return found
    side = lambda name, n: F.struct(F.col(name).alias("_symbol"), F.lit(n).alias("_side"))
    sides = found.select("*", F.explode(F.array(side("contract", 0), side("to_contract", 1))).alias("_s")).select(*found.columns, "_s.*")
    rows = bars.select(F.col("symbol").alias("_symbol"), day("timestamp").alias("roll_date"), F.col("close").alias("_close"))
    met = sides.join(rows, ["_symbol", "roll_date"]).unionByName(sides.withColumn("_close", F.lit(None).cast("double")))
    of = lambda n: F.max(F.when(F.col("_side") == n, F.col("_close")))
    return met.groupBy(*found.columns).agg(of(0).alias("from_price"), of(1).alias("to_price"))


def mean_volumes(bars: DataFrame, wanted: DataFrame, calendar: DataFrame, lookback: int) -> DataFrame:
    """wanted (with symbol and ordinal, a session's number) with mean_volume: that of the symbol's bars in the session and the `lookback` sessions before it.

    An interval join on sessions: both sides are dealt into buckets of lookback + 1 sessions, and a window lies in a bucket and
    the one before, so that a row meets the bars of two buckets at most. Sessions are those of the calendar, whether or not there is a bar.
    """
    width, names = lookback + 1, wanted.columns
    rows = bars.select("symbol", day("timestamp").alias("date"), "volume").join(F.broadcast(with_ordinal(calendar)), "date")
    rows = rows.select("symbol", F.floor(F.col("ordinal") / width).alias("_bucket"), F.col("ordinal").alias("_at"), "volume")
    bucket = F.floor(F.col("ordinal") / width)
    asked = wanted.withColumn("_bucket", F.explode(F.array(bucket, bucket - 1)))
    met = asked.join(rows, ["symbol", "_bucket"]).where(F.col("_at").between(F.col("ordinal") - lookback, F.col("ordinal")))
    found = met.groupBy(*names).agg(F.avg("volume").alias("mean_volume"))
    return wanted.join(found, names, "left")


def near_expiry(bars: DataFrame, contracts: DataFrame, calendar: DataFrame, lookback: int = 7, near: int = 7) -> DataFrame:
    """Per root and session of the calendar: nearest and second contract, their mean volumes, whether the nearest is near its end, and active_contract.

    contracts: root, symbol, last_date (the day of expiry). Volumes count from `near` sessions before the nearest contract's
    expiry on; the second contract is active if its mean volume is the greater one there, else the nearest. Only
    these sessions are joined with bars. Without a bar of either in the sessions that count the nearest stays.
    """
    ordinals = with_ordinal(calendar)
    dates = bars.select("root", day("timestamp").alias("date")).distinct().join(F.broadcast(ordinals), "date")
    two = continuous_mapping(dates.select("root", "date"), contracts, 2)
    of = lambda n: F.max(F.when(F.col("position") == n, F.col("symbol")))
    both = two.groupBy("root", "date").agg(of(1).alias("nearest"), of(2).alias("second")).where("nearest IS NOT NULL")
    # the last session before an expiry, by the calendar; the n-th before it is n - 1 earlier
    before = on_or_before(contracts.select(F.col("symbol").alias("nearest"), F.date_sub("last_date", 1).alias("_until")), calendar, "_until").select("nearest", (F.col("ordinal") - (near - 1)).alias("_from"))
    known = both.join(dates, ["root", "date"]).join(before, "nearest", "left")
    known = known.withColumn("near", F.coalesce(F.col("ordinal") >= F.col("_from"), F.lit(False))).drop("_from")
    asked = known.where(F.col("near") & F.col("second").isNotNull()).select("root", "date", "ordinal", F.explode(F.array("nearest", "second")).alias("symbol"))
    means = mean_volumes(bars, asked, calendar, lookback).select("root", "date", "symbol", "mean_volume")
    side = lambda name: means.select("root", "date", F.col("symbol").alias(name), F.col("mean_volume").alias(f"{name}_volume"))
    out = known.join(side("nearest"), ["root", "date", "nearest"], "left").join(side("second"), ["root", "date", "second"], "left")
    active = F.when(F.col("second_volume") > F.col("nearest_volume"), F.col("second")).otherwise(F.col("nearest"))
    return out.select("root", "date", "nearest", "second", "near", "nearest_volume", "second_volume", active.alias("active_contract"))


def active_by_volume(bars: DataFrame, contracts: DataFrame, calendar: DataFrame, lookback: int = 7, near: int = 7) -> DataFrame:
    """(root, date, active_contract, rolled_from) by near_expiry(); rolled_from: the contract before, on days on which it changes."""
    days = near_expiry(bars, contracts, calendar, lookback, near)
    before = F.lag("active_contract").over(Window.partitionBy("root").orderBy("date"))
    return days.select("root", "date", "active_contract", F.when(before != F.col("active_contract"), before).alias("rolled_from"))


def rolls_of(active: DataFrame) -> DataFrame:
    """The roll list of active_by_volume()."""
    return active.where("rolled_from IS NOT NULL").select("root", F.col("date").alias("roll_date"), F.col("rolled_from").alias("from_contract"), F.col("active_contract").alias("to_contract"))


def continuous_mapping(dates: DataFrame, contracts: DataFrame, n: int = 3) -> DataFrame:
    """(root, date, position, symbol): the n nearest contracts whose last day is on or after each date.

    A date meets the contracts by rank: the number of contracts that have ended before it tells the first live one,
    so that no date is joined with all contracts.
    """
    w = Window.partitionBy("root").orderBy("last_date", "symbol")
    ranked = contracts.select("root", "symbol", "last_date", F.row_number().over(w).alias("rank"))
    # ended(date) by a running count over the union of dates and contract ends: one shuffle by root
    marks = dates.select("root", "date", F.lit(0).alias("ends"), F.lit(0).alias("_order")).unionByName(ranked.select("root", F.date_add("last_date", 1).alias("date"), F.lit(1).alias("ends"), F.lit(-1).alias("_order")))
    ended = F.sum("ends").over(Window.partitionBy("root").orderBy("date", "_order").rowsBetween(Window.unboundedPreceding, 0))
    each = marks.withColumn("ended", ended).where("_order = 0").select("root", "date", "ended", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("position"))
    return each.withColumn("rank", (F.col("ended") + F.col("position")).cast("int")).join(ranked.drop("last_date"), ["root", "rank"]).select("root", "date", "position", "symbol")


