"""Trading calendars and expiry rules as dimension tables, for all years and roots at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: US market holidays of 2023 and 2024.
HOLIDAYS = (
    "2023-01-02", "2023-01-16", "2023-02-20", "2023-04-07", "2023-05-29", "2023-06-19", "2023-07-04", "2023-09-04", "2023-11-23", "2023-12-25",
    "2024-01-01", "2024-01-15", "2024-02-19", "2024-03-29", "2024-05-27", "2024-06-19", "2024-07-04", "2024-09-02", "2024-11-28", "2024-12-25",
)


def dates(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))


def business_calendar(spark: SparkSession, start: str, end: str, holidays: Sequence[str] = HOLIDAYS) -> DataFrame:
    days = dates(spark, start, end).where(F.weekday("date") < 5)
    return days.where(~F.col("date").isin([F.lit(h).cast("date") for h in holidays])) if holidays else days


def with_ordinal(calendar: DataFrame) -> DataFrame:
    """(date, ordinal): a calendar is a few thousand rows, so one task numbers it."""
    return calendar.select("date").withColumn("ordinal", F.row_number().over(Window.orderBy("date")).cast("long"))


def on_or_before(days: DataFrame, calendar: DataFrame, column: str = "date") -> DataFrame:
    """days with the last business day up to each date (`business`) and its ordinal; ordinals grow by one a business day."""
    known = with_ordinal(calendar).select(F.col("date").alias("business"), "ordinal")
    upto = known.withColumn("until", F.coalesce(F.lead("business").over(Window.orderBy("business")), F.date_add("business", 10)))
    return days.join(F.broadcast(upto), (F.col(column) >= F.col("business")) & (F.col(column) < F.col("until")), "left").drop("until")


def trading_day_offset(days: DataFrame, calendar: DataFrame, n: int, column: str = "date") -> DataFrame:
    """The n-th business day after (before, if negative) the last one up to each date, as `shifted`."""
    numbered = with_ordinal(calendar).select(F.col("date").alias("shifted"), F.col("ordinal").alias("at"))
    found = on_or_before(days, calendar, column)
    return found.join(F.broadcast(numbered), F.col("ordinal") + n == F.col("at"), "left").drop("at", "ordinal", "business")


def instant(date: Column | str, time: str, zone: str) -> Column:
    """The instant of a time of day (hh:mm:ss) of a zone on a date.

    An hour that the clocks of the zone skip counts as that much later, one that they repeat as its first time.
    """
    d = F.col(date) if isinstance(date, str) else date
    hours, minutes, seconds = time.split(":")
    return F.make_timestamp_ltz(F.year(d), F.month(d), F.dayofmonth(d), F.lit(int(hours)), F.lit(int(minutes)), F.lit(float(seconds)).cast("decimal(16,6)"), F.lit(zone))


def months(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    start, end = F.lit(f"{first_year}-01-01").cast("date"), F.lit(f"{last_year}-12-01").cast("date")
    return spark.range(1).select(F.explode(F.sequence(start, end, F.expr("interval 1 month"))).alias("month"))


def nth_weekday(month: Column, weekday: str, n: int) -> Column:
    """The n-th weekday (Mon … Sun) of the month that starts on the given date."""
    return F.date_add(F.next_day(F.date_sub(month, 1), weekday), 7 * (n - 1))


def third_friday(month: Column) -> Column:
    return nth_weekday(month, "Fri", 3)


def vix_settlements(spark: SparkSession, first_year: int, last_year: int, holidays: Sequence[str] = HOLIDAYS) -> DataFrame:
    """Per month: settlement 30 days before the next month's third Friday, moved to the business day before
    if it or that Friday is none; and the last trading day, the business day before the settlement."""
    calendar = business_calendar(spark, f"{first_year - 1}-12-01", f"{last_year + 1}-03-31", holidays)
    base = months(spark, first_year, last_year).withColumn("friday", third_friday(F.add_months("month", 1))).withColumn("wednesday", F.date_sub("friday", 30))
    open_days = F.broadcast(calendar.select(F.col("date").alias("open_day")))
    fridays = base.join(open_days, F.col("friday") == F.col("open_day"), "left").withColumn("friday_open", F.col("open_day").isNotNull()).drop("open_day")
    moved = on_or_before(fridays.withColumn("wanted", F.when(F.col("friday_open"), F.col("wednesday")).otherwise(F.date_sub("wednesday", 1))), calendar, "wanted")
    settled = moved.select("month", F.col("business").alias("settlement"))
    return trading_day_offset(settled, calendar, -1, "settlement").select("month", "settlement", F.col("shifted").alias("last_trading_day"))


def expected_expiries(spark: SparkSession, first_year: int, last_year: int, holidays: Sequence[str] = HOLIDAYS) -> DataFrame:
    """The Wednesday before each third Friday, moved back over holidays."""
    calendar = business_calendar(spark, f"{first_year - 1}-12-01", f"{last_year}-12-31", holidays)
    wanted = months(spark, first_year, last_year).withColumn("wanted", F.date_sub(third_friday(F.col("month")), 2))
    return on_or_before(wanted, calendar, "wanted").select("month", F.col("business").alias("expiry"))


#: Columns of expiry rules: root, kind, weekday (0: Monday), n, day. Kinds: weekday (the n-th such trading day of the month), before_day (n trading
#: days before a day of the month), before_last (n trading days before the month's last), vx (30 days before the next month's third Friday).
RULES = "root string, kind string, weekday int, n int, day int"


def ranked_days(calendar: DataFrame) -> DataFrame:
    """(date, ordinal, month, weekday, nth, back): each trading day with its place among those of its weekday in the month, and from the month's end."""
    month, weekday = F.trunc("date", "month").alias("month"), F.weekday("date").alias("weekday")
    known = with_ordinal(calendar).select("date", "ordinal", month, weekday)
    place = lambda keys, order: F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return known.withColumns({"nth": place(("month", "weekday"), F.col("date")), "back": place(("month",), F.col("date").desc())})


def rule_expiry(contracts: DataFrame, rules: DataFrame, calendar: DataFrame) -> DataFrame:
    """contracts (root, month, …) with rule (its kind) and expiry, by the rules (RULES) of their roots.

    A rule that the month has no day for, and a root without a rule, give the 15th. before_day counts from the days strictly before
    its day, and not further back than five days before the month. vx takes Fridays that are trading days, and of a
    Wednesday that is none the last trading day of the five days before it (none: that Wednesday).
    """
    days = ranked_days(calendar)
    ruled = contracts.join(F.broadcast(rules.select("root", F.col("kind").alias("rule"), F.col("weekday").alias("_weekday"), F.col("n").alias("_n"), F.col("day").alias("_day"))), "root", "left")
    by_weekday = days.select(F.col("month"), F.col("weekday").alias("_weekday"), F.col("nth").alias("_n"), F.col("date").alias("_by_weekday"))
    by_end = days.select(F.col("month"), (F.col("back") - 1).alias("_n"), F.col("date").alias("_by_end"))
    fridays = days.where("weekday = 4 AND nth = 3").select(F.add_months("month", -1).alias("month"), F.date_sub("date", 30).alias("_wednesday"))
    out = ruled.join(F.broadcast(by_weekday), ["month", "_weekday", "_n"], "left").join(F.broadcast(by_end), ["month", "_n"], "left").join(F.broadcast(fridays), "month", "left")
    # the last trading day up to a wanted one, with its ordinal
    wanted = F.when(F.col("rule") == "before_day", F.date_add("month", F.col("_day") - 2)).when(F.col("rule") == "vx", F.col("_wednesday"))
    found = on_or_before(out.withColumn("_wanted", wanted), calendar, "_wanted")
    numbered = days.select(F.col("date").alias("_back"), F.col("ordinal").alias("_at"))
    found = found.join(F.broadcast(numbered), F.col("ordinal") - (F.col("_n") - 1) == F.col("_at"), "left")
    of = lambda kind, value: F.when(F.col("rule") == kind, value)
    expiry = F.coalesce(
        of("weekday", F.col("_by_weekday")), of("before_last", F.col("_by_end")), of("before_day", F.when(F.col("_back") >= F.date_sub("month", 5), F.col("_back"))),
        of("vx", F.when(F.col("business") >= F.date_sub("_wednesday", 5), F.col("business")).otherwise(F.col("_wednesday"))), F.date_add("month", 14),
    )
    return found.select(*contracts.columns, "rule", expiry.alias("expiry"))


def holiday_label(date: Column) -> Column:
    """The name of a US holiday by month, weekday and day, or null."""
    month, day, weekday = F.month(date), F.dayofmonth(date), F.weekday(date)
    return (
        F.when((month == 1) & (day == 1), "New Year")
        .when((month == 1) & (weekday == 0) & day.between(15, 21), "Martin Luther King Day")
        .when((month == 2) & (weekday == 0) & day.between(15, 21), "Presidents Day")
        .when((month == 5) & (weekday == 0) & (day >= 25), "Memorial Day")
        .when((month == 6) & (day == 19), "Juneteenth")
        .when((month == 7) & (day == 4), "Independence Day")
        .when((month == 9) & (weekday == 0) & (day <= 7), "Labor Day")
        .when((month == 11) & (weekday == 3) & day.between(22, 28), "Thanksgiving")
        .when((month == 12) & (day == 25), "Christmas")
    )


def inferred_holidays(bars: DataFrame, price: str = "close") -> DataFrame:
    """Dates on which no symbol has a valid price."""
    return bars.groupBy(F.to_date("timestamp").alias("date")).agg(F.count_if(F.col(price) > 0).alias("valid")).where("valid = 0").select("date")


def roll_offsets(contracts: DataFrame, calendar: DataFrame, offsets: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """(root, symbol, roll_type, roll_date): rolls n business days before the last trading day, of types 01X, 02X, …"""
    each = contracts.select("root", "symbol", "last_date", F.explode(F.array(*map(F.lit, offsets))).alias("n"))
    found = on_or_before(each, calendar, "last_date")
    numbered = with_ordinal(calendar).select(F.col("date").alias("roll_date"), F.col("ordinal").alias("at"))
    rolled = found.join(F.broadcast(numbered), F.col("ordinal") - F.col("n") == F.col("at"), "left")
    return rolled.select("root", "symbol", F.concat(F.lpad(F.col("n").cast("string"), 2, "0"), F.lit("X")).alias("roll_type"), "roll_date")


def near_roll(rolls: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """The first roll of each root on or after as_of less days, if it is within days of it."""
    at = F.lit(as_of).cast("date")
    coming = rolls.where(F.col("roll_date") >= F.date_sub(at, days)).groupBy("root").agg(F.min("roll_date").alias("next_roll"))
    return coming.withColumn("days_to_roll", F.datediff("next_roll", at).cast("long")).where(F.col("days_to_roll") <= days)
