"""Validation, quality metrics and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebar.functions.quantiles import joined, percentiles
from tidebar.functions.scalars import bias_corrected_kurtosis, bias_corrected_skew, by_symbol, day, r
from tidebar.operators.rows import breaks_ohlc
from tidebar.operators.windows import partition_zscore

OHLC = ("open", "high", "low", "close")


def share(cond: Column) -> Column:
    """Percentage of rows that meet a condition."""
    return r(F.count_if(cond) * 100.0 / F.count("*"))


def zscore_outliers(bars: DataFrame, column: str = "close", z: float = 3.0) -> DataFrame:
    return partition_zscore(bars, column).where(F.abs("zscore") > z).withColumn("zscore", r("zscore"))


def quality_by(bars: DataFrame, key: str) -> DataFrame:
    low = F.col("quality") < 90
    return bars.groupBy(key).agg(
        r(F.avg("quality")).alias("avg_quality"), F.min("quality").alias("min_quality"), F.max("quality").alias("max_quality"), F.count_if(low).alias("low_count"), share(low).alias("low_pct")
    )


def missing_fields(bars: DataFrame) -> DataFrame:
    counted = bars.groupBy("symbol").agg(*(F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in (*OHLC, "volume")))
    return counted.where(" + ".join(f"missing_{c}" for c in (*OHLC, "volume")) + " > 0")


def worst_symbols(bars: DataFrame, n: int = 10) -> DataFrame:
    issue = F.coalesce(breaks_ohlc(), F.lit(False)) | (F.col("quality") < 90) | F.col("close").isNull() | (F.coalesce("volume", F.lit(0)) == 0)
    return bars.groupBy("symbol").agg(share(issue).alias("issue_pct"), F.count("*").alias("n")).orderBy(F.col("issue_pct").desc(), "symbol").limit(n)


def completeness_check(bars: DataFrame) -> DataFrame:
    daily = bars.groupBy("symbol", day("timestamp").alias("date")).agg(F.count("*").alias("n"))
    return daily.groupBy("symbol").agg(F.count("*").alias("days"), F.count_if(F.col("n") > 1).alias("duplicate_days"))


def quality_score_symbol(bars: DataFrame) -> DataFrame:
    of = lambda cond: F.avg(F.coalesce(cond, F.lit(False)).cast("double"))
    price = F.col("open").isNull() | F.col("high").isNull() | F.col("low").isNull() | F.col("close").isNull()
    score = 100 - 30 * of(F.col("quality") < 90) - 30 * of(price) - 20 * of(F.col("volume").isNull()) - 20 * of(breaks_ohlc())
    return bars.groupBy("symbol").agg(r(score).alias("score"))


def source_consistency(bars: DataFrame, least: float = 0.01) -> DataFrame:
    daily = bars.groupBy("symbol", day("timestamp").alias("date"), "source").agg(r(F.avg("close")).alias("avg_close"), r(F.stddev_samp("close")).alias("std_close"))
    return daily.where(F.col("std_close") > least)


def freshness(bars: DataFrame) -> DataFrame:
    newest = bars.agg(F.max("timestamp").alias("as_of"))
    dated = bars.crossJoin(F.broadcast(newest))
    age = F.datediff("as_of", "timestamp")
    out = dated.groupBy("symbol").agg(
        F.max("timestamp").alias("last"), F.min(age).alias("_age"), F.count_if(age <= 1).alias("last_day"), F.count_if(age <= 7).alias("last_week")
    )
    return out.withColumn("status", F.when(F.col("_age") <= 1, "CURRENT").when(F.col("_age") <= 7, "RECENT").otherwise("STALE")).drop("_age")


def symbol_consistency(bars: DataFrame) -> DataFrame:
    out = bars.groupBy("symbol").agg(F.count_distinct("interval_unit").alias("units"), F.count_distinct("source").alias("sources"))
    return out.where("units > 1 OR sources > 1")


def completeness_report(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(
        F.count("*").alias("n"), F.count_distinct(day("timestamp")).alias("trading_days"), share(F.col("close").isNull() | F.col("open").isNull()).alias("missing_pct"), share(F.col("quality") < 90).alias("low_quality_pct")
    )


#: Rules of bars by name: conditions that must hold, and the column they are about.
BAR_RULES: dict[str, tuple[str, str]] = {
    "high_not_below_low": ("high >= low", "high"),
    "positive_close": ("close > 0", "close"),
    "volume_not_zero": ("volume > 0", "volume"),
    "close_in_range": ("close BETWEEN low AND high", "close"),
}


def validate(df: DataFrame, rules: dict[str, tuple[str, str]], keys: Sequence[str]) -> DataFrame:
    """A row (keys, rule, field, record) for each rule that a row breaks, in one pass; null conditions are no failures."""
    failed = F.array_compact(F.array(*(F.when(F.expr(f"NOT ({cond})"), F.struct(F.lit(name).alias("rule"), F.lit(column).alias("field"))) for name, (cond, column) in rules.items())))
    return df.select(*keys, F.to_json(F.struct(*df.columns)).alias("record"), F.inline(failed))


def validation_batch(df: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """Rows, failures over all rules and by rule, in one aggregation."""
    return df.agg(F.count("*").alias("n"), *(F.count_if(F.expr(f"NOT ({cond})")).alias(f"failed_{name}") for name, (cond, _) in rules.items()))


def validation_metrics(df: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """Completeness of each column, the mean coefficient of variation of prices by symbol, and the share of rows that break no rule."""
    broken = F.lit(False)
    for cond, _ in rules.values():
        broken = broken | F.coalesce(F.expr(f"NOT ({cond})"), F.lit(False))
    cols = [*OHLC, "volume"]
    per = df.groupBy("symbol").agg(
        F.count("*").alias("n"), F.count_if(broken).alias("bad"), F.try_divide(F.stddev_samp("close"), F.avg("close")).alias("cv"), *(F.count(c).alias(f"has_{c}") for c in cols)
    )
    return per.agg(
        F.sum("n").alias("n"), r(F.avg("cv")).alias("avg_price_cv"), r(100 - F.sum("bad") * 100.0 / F.sum("n")).alias("overall_score"),
        *(r(F.sum(f"has_{c}") * 100.0 / F.sum("n")).alias(f"complete_{c}") for c in cols),
    )


def price_checks(bars: DataFrame) -> DataFrame:
    zero = F.coalesce(F.least(*OHLC) == 0, F.lit(False))
    extreme = F.coalesce(F.try_divide(F.col("high") - F.col("low"), F.col("low")) > 0.5, F.lit(False))
    return bars.groupBy("symbol").agg(
        F.count_if(breaks_ohlc()).alias("ohlc_errors"), F.count_if(zero).alias("zero_rows"), F.count_if(extreme).alias("extreme_rows"),
        *(f(c).alias(f"{name}_{c}") for c in OHLC for name, f in (("min", F.min), ("max", F.max))),
    )


def volume_checks(bars: DataFrame, z: float = 3.0) -> DataFrame:
    scored = partition_zscore(bars, "volume")
    return scored.groupBy("symbol").agg(
        F.count_if(F.col("volume") == 0).alias("zero_days"), F.count_if(F.abs("zscore") > z).alias("spikes"), r(F.avg("volume")).alias("avg_volume"), F.max("volume").alias("max_volume")
    )


def statistical_checks(bars: DataFrame, z: float = 3.0) -> DataFrame:
    """Outliers of return, range and overnight gap by symbol."""
    before = F.lag("close").over(by_symbol())
    df = bars.withColumns({"ret": F.try_divide(F.col("close"), before) - 1, "range": F.try_divide(F.col("high") - F.col("low"), F.col("close")), "gap": F.try_divide(F.col("open"), before) - 1})
    w = Window.partitionBy("symbol")
    for c in ("ret", "range", "gap"):
        df = df.withColumn(f"z_{c}", F.try_divide(F.col(c) - F.avg(c).over(w), F.stddev_samp(c).over(w)))
    return df.groupBy("symbol").agg(*(F.count_if(F.abs(f"z_{c}") > z).alias(f"{c}_outliers") for c in ("ret", "range", "gap")), *(r(F.avg(c)).alias(f"avg_{c}") for c in ("ret", "range", "gap")))


def descriptive_stats(bars: DataFrame, columns: Sequence[str] = ("close", "volume")) -> DataFrame:
    """A row for each symbol and column: n, min, max, mean, median, deviation, skew, kurtosis, zeros."""
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in columns))
    long = bars.select("symbol", F.inline(rows))
    n = F.count("value")
    out = long.groupBy("symbol", "field").agg(
        n.alias("n"), F.min("value").alias("min"), F.max("value").alias("max"), r(F.avg("value")).alias("mean"), r(F.stddev_samp("value")).alias("std"),
        r(bias_corrected_skew(F.col("value"), n), 4).alias("skew"), r(bias_corrected_kurtosis(F.col("value"), n), 4).alias("kurtosis"), F.count_if(F.col("value") == 0).alias("zeros"),
    )
    middle = percentiles(long, ["symbol", "field"], {"_median": F.col("value")}, [0.5])
    return joined(out, middle, ["symbol", "field"]).withColumn("median", r(F.col("_median")[0])).drop("_median")


def missing_summary(df: DataFrame) -> DataFrame:
    """A row for each column: missing cells and their share."""
    counted = df.agg(F.count("*").alias("_n"), *(F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns))
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("missing"), r(F.try_divide(F.col(f"`{c}`") * 100.0, F.col("_n"))).alias("missing_pct")) for c in df.columns))
    return counted.select(F.inline(rows))


def sigma_outliers(bars: DataFrame, k: float = 3.0) -> DataFrame:
    """(symbol, timestamp, field, value) outside mean and k deviations of the symbol's column."""
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in OHLC))
    long = bars.select("symbol", "timestamp", F.inline(rows))
    w = Window.partitionBy("symbol", "field")
    return long.withColumns({"_m": F.avg("value").over(w), "_s": F.stddev_samp("value").over(w)}).where(F.abs(F.col("value") - F.col("_m")) > k * F.col("_s")).drop("_m", "_s")


def extreme_returns(bars: DataFrame, k: float = 3.0) -> DataFrame:
    w = Window.partitionBy("symbol")
    df = bars.withColumn("ret", F.try_divide(F.col("close"), F.lag("close").over(by_symbol())) - 1)
    return df.withColumns({"_m": F.avg("ret").over(w), "_s": F.stddev_samp("ret").over(w)}).where(F.abs(F.col("ret") - F.col("_m")) > k * F.col("_s")).select("symbol", "timestamp", r("ret").alias("ret"))


#: Kinds of inconsistency, as conditions.
ISSUES: dict[str, str] = {
    "high_below_low": "high < low",
    "open_outside": "open > high OR open < low",
    "close_outside": "close > high OR close < low",
    "negative_price": "least(open, high, low, close) < 0",
    "low_volume": "volume < 2",
}


def consistency_report(bars: DataFrame, issues: dict[str, str] = ISSUES) -> DataFrame:
    """Count and share of each issue over all bars, in one pass."""
    counted = bars.agg(F.count("*").alias("_n"), *(F.count_if(F.expr(cond)).alias(name) for name, cond in issues.items()))
    rows = F.array(*(F.struct(F.lit(name).alias("issue"), F.col(name).alias("n"), r(F.try_divide(F.col(name) * 100.0, F.col("_n"))).alias("pct")) for name in issues))
    return counted.select(F.inline(rows))


def consistency_examples(bars: DataFrame, n: int = 10, issues: dict[str, str] = ISSUES) -> DataFrame:
    """The first n rows of each issue."""
    found = F.array_compact(F.array(*(F.when(F.expr(cond), F.lit(name)) for name, cond in issues.items())))
    each = bars.select("symbol", "timestamp", F.explode(found).alias("issue"))
    return each.withColumn("_r", F.row_number().over(Window.partitionBy("issue").orderBy("timestamp", "symbol"))).where(F.col("_r") <= n).drop("_r")


def multi_method_outliers(series: DataFrame, reference: DataFrame, z: float = 4.0, iqr: float = 3.0, change: float = 0.3, bounds: tuple[float, float] = (1.0, 5000.0), deviation: float = 0.3) -> DataFrame:
    """(symbol, timestamp, value, methods): values that any method finds; series: symbol, timestamp, value; reference: timestamp, value."""
    stats = series.groupBy("symbol").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
    stats = joined(stats, percentiles(series, ["symbol"], {"_q": F.col("value")}, [0.25, 0.75]), ["symbol"])
    before = F.lag("value").over(by_symbol())
    df = series.withColumn("_change", F.abs(F.try_divide(F.col("value"), before) - 1)).join(stats, "symbol").join(reference.select("timestamp", F.col("value").alias("_ref")), "timestamp", "left")
    spread = F.col("_q")[1] - F.col("_q")[0]
    methods = F.array_compact(
        F.array(
            F.when(F.abs(F.try_divide(F.col("value") - F.col("_m"), F.col("_s"))) > z, F.lit("zscore")),
            F.when((F.col("value") < F.col("_q")[0] - iqr * spread) | (F.col("value") > F.col("_q")[1] + iqr * spread), F.lit("iqr")),
            F.when(F.col("_change") > change, F.lit("change")),
            F.when((F.col("value") < bounds[0]) | (F.col("value") > bounds[1]), F.lit("bounds")),
            F.when(F.abs(F.try_divide(F.col("value"), F.col("_ref")) - 1) > deviation, F.lit("reference")),
        )
    )
    return df.select("symbol", "timestamp", "value", F.array_join(methods, ",").alias("methods")).where("methods <> ''").dropDuplicates(["symbol", "timestamp", "value"])


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and an estimate of bytes of each table, by the widths of its types."""
    width = {"string": 16, "int": 4, "double": 8, "bigint": 8, "boolean": 1, "timestamp": 8, "timestamp_ntz": 8, "date": 4}
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("name"), "n", F.lit(len(df.columns)).cast("long").alias("columns"), (F.col("n") * sum(width.get(k, 32) for _, k in df.dtypes)).alias("estimated_bytes")
        )
        out = row if out is None else out.unionByName(row)
    return out
