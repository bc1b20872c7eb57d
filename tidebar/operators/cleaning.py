"""Cleaning and repair of bars: rules from DataFrames to DataFrames, and a pipeline of them with a change log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebar.functions.quantiles import percentiles
from tidebar.functions.scalars import by_symbol, guarded, next_value, r
from tidebar.operators.windows import centred_band

OHLC = ("open", "high", "low", "close")


def fix_ohlc(bars: DataFrame) -> DataFrame:
    """High becomes the greatest and low the least of the four prices; nulls are skipped."""
    cols = [F.col(c) for c in OHLC]
    return bars.withColumns({"high": F.greatest(*cols), "low": F.least(*cols)})


def swap_high_low(bars: DataFrame) -> DataFrame:
    wrong = F.col("high") < F.col("low")
    return bars.withColumns({"high": F.when(wrong, F.col("low")).otherwise(F.col("high")), "low": F.when(wrong, F.col("high")).otherwise(F.col("low"))})


def fill_by_ratio(target: DataFrame, reference: DataFrame, n: int = 60) -> DataFrame:
    """(date, value, quality): the target, and where only the reference has a value, it times the mean ratio of the first n common dates.

    Both: (date, value).
    """
    both = reference.select("date", F.col("value").alias("ref")).join(target.select("date", F.col("value").alias("own")), "date", "full_outer")
    common = both.where("own IS NOT NULL AND ref IS NOT NULL AND ref <> 0").orderBy("date").limit(n)
    ratio = common.agg(F.avg(F.col("own") / F.col("ref")).alias("ratio"))
    out = both.crossJoin(F.broadcast(ratio))
    filled = F.col("own").isNull() & F.col("ref").isNotNull() & F.col("ratio").isNotNull()
    return out.select("date", F.when(filled, F.col("ref") * F.col("ratio")).otherwise(F.col("own")).alias("value"), F.when(filled, 80).otherwise(100).alias("quality")).where("value IS NOT NULL")


def interpolate(bars: DataFrame, columns: Sequence[str], by: str = "position", limit: int | None = None) -> DataFrame:
    """Nulls between two values lie on the line between them, by position (rows) or time; after the last value it goes on.

    limit: rows after a value that are filled, at most.
    """
    out = bars.withColumn("_n", F.row_number().over(by_symbol()))
    made = {}
    w = by_symbol()
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    x = F.col("_n").cast("double") if by == "position" else F.unix_micros("timestamp").cast("double")
    for c in columns:
        there = F.col(c).isNotNull()
        x0, x1 = F.last(F.when(there, x), ignorenulls=True).over(back), next_value(F.when(there, x))
        y0, y1 = F.last(c, ignorenulls=True).over(back), next_value(c)
        line = F.when(x1.isNull(), y0).otherwise(y0 + (y1 - y0) * F.try_divide(x - x0, x1 - x0))
        if limit is not None:
            line = F.when(F.col("_n") - F.last(F.when(there, F.col("_n")), ignorenulls=True).over(back) <= limit, line)
        made[c] = F.coalesce(F.col(c), line)
    return out.withColumns(made).drop("_n")


def interpolate_zero(bars: DataFrame, columns: Sequence[str] = OHLC, eps: float = 1e-6, least_valid: float = 0.5) -> DataFrame:
    """Zeros and nulls interpolated where enough of a symbol's column is valid; results that are not positive are left out."""
    whole = Window.partitionBy("symbol")
    blank = bars.withColumns({f"_was_{c}": F.col(c) for c in columns} | {c: F.when(F.abs(c) >= eps, F.col(c)) for c in columns})
    share = {f"_valid_{c}": F.avg(F.col(c).isNotNull().cast("double")).over(whole) for c in columns}
    filled = interpolate(blank.withColumns(share), columns)
    good = {c: F.when(F.col(f"_was_{c}").isNotNull() & (F.abs(f"_was_{c}") >= eps), F.col(f"_was_{c}")).when((F.col(f"_valid_{c}") >= least_valid) & (F.col(c) > 0), F.col(c)).otherwise(F.col(f"_was_{c}")) for c in columns}
    return filled.withColumns(good).drop(*share, *(f"_was_{c}" for c in columns))


def _median_near(column: str, w: int) -> Column:
    """Median of the positive values within w rows, the row's own left out, if at least w are there."""
    own = by_symbol()
    near = F.concat(F.collect_list(F.when(F.col(column) > 0, F.col(column))).over(own.rowsBetween(-w, -1)), F.collect_list(F.when(F.col(column) > 0, F.col(column))).over(own.rowsBetween(1, w)))
    return F.transform(
        F.array(F.array_sort(near)),
        lambda a: F.when(F.size(a) >= w, (F.element_at(a, F.floor((F.size(a) + 1) / 2).cast("int")) + F.element_at(a, F.floor((F.size(a) + 2) / 2).cast("int"))) / 2),
    )[0]


def estimate_volume(bars: DataFrame, w: int = 5, column: str = "volume", digits: int = -2) -> DataFrame:
    """Zero or null volume from the median of its neighbours, rounded to hundreds."""
    bad = F.col(column).isNull() | (F.col(column) == 0)
    return bars.withColumn(column, F.when(bad, F.coalesce(F.round(_median_near(column, w), digits).cast("long"), F.col(column))).otherwise(F.col(column)))


def estimate_open_interest(bars: DataFrame, w: int = 5, column: str = "open_interest") -> DataFrame:
    """The positive value before, else after, else as volume."""
    own = by_symbol()
    bad = F.col(column).isNull() | (F.col(column) == 0)
    positive = lambda c: F.when(c > 0, c)
    value = F.coalesce(positive(F.lag(column).over(own)), positive(F.lead(column).over(own)), F.round(_median_near(column, w), -2).cast("long"), F.col(column))
    return bars.withColumn(column, F.when(bad, value).otherwise(F.col(column)))


def rescale_by_median(bars: DataFrame, below: float = 1.0, factor: float = 1000.0) -> DataFrame:
    """Prices of a symbol times factor if the median of its columns' medians is below a bound."""
    medians = percentiles(bars, ["symbol"], {c: F.col(c) for c in OHLC}, [0.5]).select("symbol", *(F.col(c)[0].alias(c) for c in OHLC))
    of = F.array_sort(F.array_compact(F.array(*OHLC)))
    middle = F.transform(F.array(of), lambda a: (F.try_element_at(a, F.floor((F.size(a) + 1) / 2).cast("int")) + F.try_element_at(a, F.floor((F.size(a) + 2) / 2).cast("int"))) / 2)[0]
    low = medians.select("symbol", F.coalesce(middle < below, F.lit(False)).alias("_low"))
    return bars.join(low, "symbol", "left").withColumns({c: F.when(F.col("_low"), F.col(c) * factor).otherwise(F.col(c)) for c in OHLC}).drop("_low")


def crossfill(bars: DataFrame) -> DataFrame:
    return bars.withColumns({"close": F.coalesce("close", "settle"), "settle": F.coalesce("settle", "close")})


def cap_outliers(bars: DataFrame, k: float = 4.0, columns: Sequence[str] = OHLC) -> DataFrame:
    """Prices held within k deviations of a centred band."""
    df = bars
    for c in columns:
        df = centred_band(df, c)
        low, high = F.col("band_mean") - k * F.col("band_std"), F.col("band_mean") + k * F.col("band_std")
        held = F.when(F.col(c).isNotNull() & F.col("band_std").isNotNull(), F.least(F.greatest(F.col(c), low), high)).otherwise(F.col(c))
        df = df.withColumn(f"_{c}", held).drop("band_mean", "band_std")
    return df.withColumns({c: F.col(f"_{c}") for c in columns}).drop(*(f"_{c}" for c in columns))


def fill_missing_ohlc(bars: DataFrame) -> DataFrame:
    """Open from close, else the middle of the close before and the open after; the others alike."""
    w = by_symbol()
    middle = (F.lag("close").over(w) + F.lead("open").over(w)) / 2
    filled = bars.withColumn("_middle", middle)
    return filled.withColumns(
        {
            "open": F.coalesce("open", "close", "_middle"),
            "close": F.coalesce("close", "open", "_middle"),
            "high": F.coalesce("high", F.greatest("open", "close"), "_middle"),
            "low": F.coalesce("low", F.least("open", "close"), "_middle"),
        }
    ).drop("_middle")


def clamp_into_range(bars: DataFrame, columns: Sequence[str] = ("open", "close")) -> DataFrame:
    held = lambda c: F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.col("low")), F.col("high")))
    return bars.withColumns({c: held(c) for c in columns})


def price_spike(bars: DataFrame, max_dev: float = 50.0, w: int = 5, action: str = "average", column: str = "close") -> DataFrame:
    """Values that deviate from the mean of the w rows before by over max_dev per cent: average, previous, interpolate or flag."""
    own = by_symbol()
    df = bars.withColumn("_mean", F.avg(column).over(own.rowsBetween(-w, -1))).withColumn("_before", F.lag(column).over(own))
    spike = F.coalesce(F.try_divide(F.abs(F.col(column) - F.col("_mean")) * 100.0, F.col("_mean")) > max_dev, F.lit(False))
    if action == "flag":
        return df.withColumn("spike", spike).drop("_mean", "_before")
    if action == "interpolate":
        return interpolate(df.withColumn(column, F.when(~spike, F.col(column))), [column]).drop("_mean", "_before")
    return df.withColumn(column, F.when(spike, F.col("_mean" if action == "average" else "_before")).otherwise(F.col(column))).drop("_mean", "_before")


def minimum_value(bars: DataFrame, columns: Sequence[str], value: float) -> DataFrame:
    return bars.withColumns({c: F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.lit(value))) for c in columns})


def fix_negative(bars: DataFrame, columns: Sequence[str], action: str = "zero") -> DataFrame:
    return bars.withColumns({c: F.when(F.col(c) < 0, F.abs(c) if action == "abs" else F.lit(0)).otherwise(F.col(c)) for c in columns})


def fill_volume(bars: DataFrame, w: int = 5) -> DataFrame:
    """Null volume from the mean of the rows up to it."""
    mean = F.avg("volume").over(by_symbol().rowsBetween(-w + 1, 0))
    return bars.withColumn("volume", F.coalesce("volume", F.round(mean).cast("long")))


def copy_previous(ticks: DataFrame, condition: Column, column: str = "close") -> DataFrame:
    """Missing values under the condition take the last one before."""
    last = F.last(column, ignorenulls=True).over(by_symbol().rowsBetween(Window.unboundedPreceding, 0))
    return ticks.withColumn(column, F.when(F.col(column).isNull() & condition, last).otherwise(F.col(column)))


def flag_gap(bars: DataFrame, pct: float = 5.0) -> DataFrame:
    before = F.lag("close").over(by_symbol())
    return bars.withColumn("price_gap", F.coalesce(F.abs(F.try_divide(F.col("close") - before, before)) * 100 > pct, F.lit(False)))


def drop_return_outliers(bars: DataFrame, k: float = 5.0, n: int = 20, least: int = 5) -> DataFrame:
    """Without rows whose return is over k rolling deviations (from at least so many returns)."""
    df = bars.withColumn("_ret", F.try_divide(F.col("close"), F.lag("close").over(by_symbol())) - 1)
    w = by_symbol().rowsBetween(-n + 1, 0)
    df = df.withColumn("_std", guarded(least, F.stddev_samp("_ret").over(w), F.col("_ret"), w))
    return df.where(~F.coalesce(F.abs("_ret") > k * F.col("_std"), F.lit(False))).drop("_ret", "_std")


def dedupe_best(bars: DataFrame, keys: Sequence[str] = ("symbol", "timestamp"), tie: str = "id", values: Sequence[str] = OHLC) -> DataFrame:
    """One row of each key: that with the fewest nulls, then the least id."""
    nulls = reduce(lambda a, b: a + b, (F.col(c).isNull().cast("int") for c in values))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(nulls, tie))
    return bars.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def quality_score(bars: DataFrame) -> DataFrame:
    """100 less 20 for each null price, 15 for a high or low that others break, 25 for high below low; not below 0."""
    true = lambda cond: F.coalesce(F.expr(cond), F.lit(False)).cast("int")
    score = F.lit(100)
    for c in OHLC:
        score = score - 20 * F.col(c).isNull().cast("int")
    score = score - 15 * true("high < open OR high < close") - 15 * true("low > open OR low > close") - 25 * true("high < low")
    return bars.withColumn("quality_score", F.greatest(score, F.lit(0)))


def after_expiry(bars: DataFrame, expiries: DataFrame) -> DataFrame:
    """Rows of contracts after their expiry; expiries: symbol, expiry."""
    return bars.join(expiries, "symbol").where(F.to_date("timestamp") > F.col("expiry"))


def fill_zero_prices(series: DataFrame, reference: DataFrame, limit: int = 5, recent: int = 60, least: int = 10) -> DataFrame:
    """(root, position, date, value, method, quality): zero prices of a term structure, filled in order of trust.

    By time between neighbours (within limit rows); later positions by the mean ratio to the front over the last common
    dates, else by an estimate for the position; where the front has no price, and for the front itself, by the mean
    ratio to the index, else by an estimate. Dates on which no series and no index has a price are holidays and stay.
    series: root, position, date, value; reference: root, date, value.
    """
    valid = F.when(F.col("value") > 0, F.col("value"))
    df = series.select(F.concat_ws("#", "root", "position").alias("symbol"), "root", "position", F.col("date").cast("timestamp").alias("timestamp"), valid.alias("value"), F.col("value").alias("_raw"))
    lined = interpolate(df.withColumn("line", F.col("value")), ["line"], by="time", limit=limit)
    lined = lined.withColumn("line", F.when(next_value("value").isNotNull(), F.col("line")))
    # the front and the index of each date, beside all positions of the date
    index = reference.select("root", F.col("date").cast("timestamp").alias("timestamp"), F.when(F.col("value") > 0, F.col("value")).alias("index_value"))
    whole = Window.partitionBy("root", "timestamp")
    both = lined.withColumn("front", F.max(F.when(F.col("position") == 1, F.col("value"))).over(whole)).join(index, ["root", "timestamp"], "left")
    open_days = both.select("timestamp", F.coalesce("value", "index_value").alias("_any")).where("_any IS NOT NULL").select("timestamp").distinct().withColumn("_open", F.lit(True))
    by_position = Window.partitionBy("root", "position").orderBy(F.col("timestamp").desc())
    back = by_position.rowsBetween(Window.unboundedPreceding, 0)
    common = {"front": F.col("value").isNotNull() & F.col("front").isNotNull(), "index_value": F.col("value").isNotNull() & F.col("index_value").isNotNull()}
    ranked = both.withColumns({f"_n_{c}": F.count(F.when(there, 1)).over(back) for c, there in common.items()})
    ratio = lambda c: F.avg(F.when(common[c] & (F.col(f"_n_{c}") <= recent), F.col("value") / F.col(c)))
    enough = lambda c: F.count_if(common[c]) >= least
    ratios = ranked.groupBy("root", "position").agg(F.when(enough("front"), ratio("front")).alias("_to_front"), F.when(enough("index_value"), ratio("index_value")).alias("_to_index"))
    both = both.join(ratios, ["root", "position"]).join(open_days, "timestamp", "left")
    later = F.col("position") > 1
    ways = (  # method, value, quality
        ("original", F.col("value"), 100),
        ("holiday", F.when(F.col("_open").isNull(), F.coalesce("_raw", F.lit(0.0))), 100),
        ("interpolated", F.col("line"), 80),
        ("ratio", F.when(later, F.col("front") * F.col("_to_front")), 75),
        ("position", F.when(later, F.col("front") * (1 + (F.col("position") - 1) * 0.03)), 75),
        ("index_ratio", F.col("index_value") * F.col("_to_index"), 75),
        ("index", F.col("index_value") * (1.1 + (F.col("position") - 1) * 0.05), 75),
    )
    pick = lambda of: F.coalesce(*(F.when(value.isNotNull(), of(name, value, quality)) for name, value, quality in ways))
    return both.select(
        "root", "position", F.to_date("timestamp").alias("date"), r(pick(lambda n, v, q: v)).alias("value"), pick(lambda n, v, q: F.lit(n)).alias("method"), pick(lambda n, v, q: F.lit(q)).alias("quality")
    )


@dataclass(frozen=True)
class Rule:
    """A cleaning rule: lower priority runs first; symbols: a regular expression of those it is for."""

    name: str
    run: Callable[[DataFrame], DataFrame]
    columns: Sequence[str]
    priority: int = 100
    enabled: bool = True
    symbols: str | None = None
    options: dict = field(default_factory=dict)


#: Rules by name, which callers may add to.
RULES: dict[str, Rule] = {
    "swap_high_low": Rule("swap_high_low", swap_high_low, ("high", "low"), 50),
    "zero_prices": Rule("zero_prices", lambda b: interpolate_zero(b, ("open", "close")), ("open", "close"), 60),
    "fix_ohlc": Rule("fix_ohlc", fix_ohlc, ("high", "low"), 80),
    "estimate_volume": Rule("estimate_volume", estimate_volume, ("volume",), 100),
}


def run_pipeline(bars: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = ("symbol", "timestamp"), keep_on_error: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The cleaned rows, a log row for each changed cell, and a summary by rule and column.

    Rules keep the rows and their keys. Values before each rule travel along in the row, so that the log needs no join.
    A rule that fails as its plan is made (an unknown column or type, an error of its own) makes the pipeline keep the
    original rows, with an empty log and one summary row that names the rule (changes -1, the error as field); unless
    keep_on_error is off. Errors of rows at run time end the job as in any query of Spark.
    """
    df, steps = bars, []
    for n, rule in enumerate(sorted((x for x in rules if x.enabled), key=lambda x: (x.priority, x.name))):
        try:
            before = df.withColumns({f"_b{n}_{c}": F.col(c) for c in rule.columns})
            after = rule.run(before)
            if rule.symbols:
                fits = F.col("symbol").rlike(rule.symbols)
                after = after.withColumns({c: F.when(fits, F.col(c)).otherwise(F.col(f"_b{n}_{c}")) for c in rule.columns})
            df = after.withColumns({f"_a{n}_{c}": F.col(c) for c in rule.columns})
            df.select(*bars.columns, *(f"_b{n}_{c}" for c in rule.columns))  # what is not there fails here
        except Exception as e:
            if not keep_on_error:
                raise
            log = bars.select(*keys, *(F.lit(None).cast(kind).alias(c) for c, kind in (("rule", "string"), ("field", "string"), ("old_value", "double"), ("new_value", "double")))).limit(0)
            failed = bars.sparkSession.range(1).select(F.lit(rule.name).alias("rule"), F.lit(f"error: {e}"[:500]).alias("field"), F.lit(-1).cast("long").alias("changes"))
            return bars, log, failed
        steps += [(rule.name, n, c) for c in rule.columns]
    cells = F.array(
        *(F.struct(F.lit(name).alias("rule"), F.lit(c).alias("field"), F.col(f"_b{n}_{c}").cast("double").alias("old_value"), F.col(f"_a{n}_{c}").cast("double").alias("new_value")) for name, n, c in steps)
    )
    log = df.select(*keys, F.inline(F.filter(cells, lambda x: ~x["old_value"].eqNullSafe(x["new_value"])))) if steps else df.select(*keys).limit(0)
    summary = log.groupBy("rule", "field").agg(F.count("*").alias("changes")) if steps else log
    return df.select(*bars.columns), log, summary


def auto_fix(bars: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Named fixes, and how many cells each has changed."""
    cleaned, _, summary = run_pipeline(bars, [RULES[n] for n in names])
    return cleaned, summary
