"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by_symbol(*order: str, key: str = "symbol") -> WindowSpec:
    return Window.partitionBy(key).orderBy(*(order or ("timestamp",)))


def last_rows(n: int, key: str = "symbol", order: str = "timestamp") -> WindowSpec:
    """The row and the n - 1 before it."""
    return by_symbol(order, key=key).rowsBetween(-n + 1, 0)


def next_value(value: Column | str, key: str = "symbol", order: str = "timestamp") -> Column:
    """The row's value or the first one after it that is not null.

    By a running window in falling order: a frame that ends with the partition would be summed up anew for each row.
    """
    w = Window.partitionBy(key).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(value, ignorenulls=True).over(w)


def guarded(n: int, value: Column, counted: Column, over: WindowSpec) -> Column:
    """value, once so many of counted are in the window."""
    return F.when(F.count(counted).over(over) >= n, value)


def pct(part: Column, whole: Column) -> Column:
    """Percentage, null where whole is zero."""
    return F.try_divide(part * 100.0, whole)


def change_pct(now: Column, before: Column) -> Column:
    return pct(now - before, before)


def r(value: Column | str, digits: int = 6) -> Column:
    return F.round(value, digits)


def weekend(date: Column) -> Column:
    return F.weekday(date) >= 5


def day(ts: Column | str) -> Column:
    return F.to_date(ts)


def newest(df: DataFrame, column: str = "timestamp") -> Column:
    """The greatest time of a column, found by a job of its own over that column, as a constant (null without rows)."""
    last = df.agg(F.max(F.unix_micros(F.col(column).cast("timestamp"))).alias("last")).first()["last"]
    return F.timestamp_micros(F.lit(last).cast("long"))


def recent(df: DataFrame, days: int, column: str = "timestamp") -> DataFrame:
    """The rows of the last days up to the newest row.

    The bound is a constant, so that it goes down to the files (where no window stands between), and what is older is not made.
    """
    return df.where(F.col(column) >= newest(df, column) - F.make_dt_interval(F.lit(days)))


def seconds(ts: Column | str) -> Column:
    return F.unix_micros(ts) / 1e6


def business_days_between(start: Column, end: Column) -> Column:
    """Weekdays strictly between two dates, in closed form: those up to end less those up to start."""

    def until(d: Column) -> Column:  # weekdays from Monday 1970-01-05 up to d, d included
        n = F.datediff(d, F.lit("1970-01-05").cast("date"))
        return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)) + 1, F.lit(5))

    return (until(F.date_sub(end, 1)) - until(start)).cast("long")


def bias_corrected_skew(value: Column, n: Column) -> Column:
    g = F.skewness(value)
    return F.when(n > 2, g * F.sqrt(n * (n - 1)) / (n - 2))


def bias_corrected_kurtosis(value: Column, n: Column) -> Column:
    g = F.kurtosis(value)
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g + 6))
