"""Contract codes and names of continuous series."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebar.sources.adapters import MONTH_CODES


def contract_codes(roots: DataFrame, years: Iterable[int], months: str = MONTH_CODES, excluded: Iterable[str] = ()) -> DataFrame:
    """(root, symbol, month): the contracts of each root in cycle months and years, without exclusions."""
    code, year = F.array(*map(F.lit, months)), F.array(*map(F.lit, years))
    each = roots.select("root", F.explode(year).alias("year")).select("root", "year", F.explode(code).alias("code"))
    out = each.select(
        "root",
        F.concat("root", "code", F.lpad((F.col("year") % 100).cast("string"), 2, "0")).alias("symbol"),
        F.make_date("year", F.instr(F.lit(MONTH_CODES), F.col("code")), F.lit(1)).alias("month"),
    )
    return out.where(~F.col("symbol").isin(list(excluded))) if excluded else out


def active_contracts(codes: DataFrame, start: str, end: str, life: int = 270) -> DataFrame:
    """Contracts whose life of so many days up to their month meets the range."""
    return codes.where((F.col("month") >= F.lit(start).cast("date")) & (F.date_sub("month", life) <= F.lit(end).cast("date")))


def parse_contract(df: DataFrame, column: str = "symbol", pivot: int = 50) -> DataFrame:
    """df with root, month number and year of a contract code; two-digit years below pivot are of 20yy."""
    pattern = rf"^(.+)([{MONTH_CODES}])([0-9]{{2}})$"
    yy = F.try_to_number(F.regexp_extract(column, pattern, 3), F.lit("99")).cast("int")
    return df.withColumns(
        {
            "parsed_root": F.regexp_extract(column, pattern, 1),
            "parsed_month": F.nullif(F.instr(F.lit(MONTH_CODES), F.nullif(F.regexp_extract(column, pattern, 2), F.lit(""))), F.lit(0)),
            "parsed_year": F.when(yy < pivot, yy + 2000).otherwise(yy + 1900),
        }
    )


CONTINUOUS = r"^@([A-Z#0-9]+)=([0-9])([0-9]{2})X([A-Z])(?:_([a-z]+))?$"


def parse_continuous(df: DataFrame, column: str = "name") -> DataFrame:
    """df with root, position, roll days, adjustment and suffix of names like @ES=102XC_d."""
    part = lambda n: F.regexp_extract(column, CONTINUOUS, n)
    return df.withColumns({"root": part(1), "position": part(2).try_cast("int"), "roll_days": part(3).try_cast("int"), "adjustment": part(4), "suffix": F.nullif(part(5), F.lit(""))})


def continuous_name(root: Column, position: Column, roll_days: Column, adjustment: Column) -> Column:
    return F.concat(F.lit("@"), root, F.lit("="), position.cast("string"), F.lpad(roll_days.cast("string"), 2, "0"), F.lit("X"), adjustment)


def futures_order(df: DataFrame, column: str = "symbol") -> list[Column]:
    """Sort keys: four-digit year, then month."""
    return [F.col("parsed_year"), F.col("parsed_month"), F.col(column)]


def base_symbol(name: Column) -> Column:
    """The root of a contract or continuous name, else the name."""
    contract = F.regexp_extract(name, rf"^([A-Z]{{2,}})[{MONTH_CODES}][0-9]{{2}}$", 1)
    cont = F.regexp_extract(name, CONTINUOUS, 1)
    return F.when(contract != "", contract).when(cont != "", cont).otherwise(name)


def interval_label(value: Column, unit: Column) -> Column:
    """1d, 15m, 2h …"""
    short = F.when(unit.isin("daily", "day"), "d").when(unit == "minute", "m").when(unit == "hour", "h").otherwise(unit)
    return F.concat(value.cast("string"), short)
