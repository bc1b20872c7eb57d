"""Exact percentiles of groups of any size.

Spark's percentile holds the different values of a group in one buffer, which serves groups of up to BUFFERED rows. Beyond, three passes hold
none: a mergeable sketch brackets the rank that is asked for; the values below and within the bracket are counted,
which proves it or not; and of those within, summed up by value where they stand, the ones at the rank are
picked. A bracket that fails is widened to the whole group, so that the result is exact whatever the sketch says.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a group for which one buffer is used.
BUFFERED = 1_000_000
#: Of the sketch: its accuracy, and how much to either side of a percentage the bracket goes.
ACCURACY, MARGIN = 10_000, 4.0 / 10_000


def percentiles(df: DataFrame, by: Sequence[str], values: dict[str, Column], shares: Sequence[float], buffered: int | None = None) -> DataFrame:
    """A row for each group: by, and name -> array<double> of the percentiles (0 to 1) of a value, interpolated between neighbours; null without values."""
    by, shares = list(by), [float(p) for p in shares]
    most = df.groupBy(*by).count().agg(F.max("count").alias("n")).first()["n"] or 0
    if most <= (BUFFERED if buffered is None else buffered):
        return df.groupBy(*by).agg(*(F.percentile(v.cast("double"), F.array(*map(F.lit, shares))).alias(name) for name, v in values.items()))
    return _bracketed(df, by, values, shares)


def joined(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """left with the columns of right (one row a group), null keys included."""
    named = right.select(*(F.col(c).alias(f"_by{k}") for k, c in enumerate(by)), *(c for c in right.columns if c not in by))
    match = F.lit(True)
    for k, c in enumerate(by):
        match = match & F.col(c).eqNullSafe(F.col(f"_by{k}"))
    return left.join(named, match, "left").drop(*(f"_by{k}" for k in range(len(by))))


def _bracketed(df: DataFrame, by: list[str], values: dict[str, Column], shares: list[float]) -> DataFrame:
    key = [*by, "_of"]
    long = df.select(*by, F.inline(F.array(*(F.struct(F.lit(n).alias("_of"), v.cast("double").alias("_v")) for n, v in values.items())))).where("_v IS NOT NULL")
    ends = [e for p in shares for e in (max(p - MARGIN, 0.0), min(p + MARGIN, 1.0))]
    sketch = long.groupBy(*key).agg(F.count("*").alias("_n"), F.percentile_approx("_v", F.array(*map(F.lit, ends)), ACCURACY).alias("_b"))
    each = F.array(*(F.struct(F.lit(i).alias("_i"), (F.lit(p) * (F.col("_n") - 1)).alias("_at"), F.col("_b")[2 * i].alias("_low"), F.col("_b")[2 * i + 1].alias("_high")) for i, p in enumerate(shares)))
    asked = sketch.select(*key, "_n", F.inline(each))
    inside = F.col("_v").between(F.col("_low"), F.col("_high"))
    sides = joined(long, asked.groupBy(*key).agg(F.collect_list(F.struct("_i", "_at", "_n", "_low", "_high")).alias("_asked")), key).select(*key, "_v", F.inline("_asked"))
    counted = sides.groupBy(*key, "_i", "_at", "_n", "_low", "_high").agg(F.count_if(F.col("_v") < F.col("_low")).alias("_below"), F.count_if(inside).alias("_within"))
    # the values at these two ranks, counted from 1, are wanted
    first, second = F.floor("_at") + 1, F.ceil("_at") + 1
    proved = (F.col("_below") < first) & (F.col("_below") + F.col("_within") >= second)
    known = counted.select(*key, "_i", "_at", first.alias("_first"), second.alias("_second"), proved.alias("_proved"), F.when(proved, F.col("_below")).otherwise(0).alias("_below"), "_low", "_high")
    wanted = known.groupBy(*key).agg(F.collect_list(F.struct("_i", "_at", "_first", "_second", "_proved", "_below", "_low", "_high")).alias("_known"))
    kept = joined(long, wanted, key).select(*key, "_v", F.inline("_known")).where(~F.col("_proved") | inside)
    by_value = kept.groupBy(*key, "_i", "_at", "_first", "_second", "_below", "_v").agg(F.count("*").alias("_times"))
    upto = F.col("_below") + F.sum("_times").over(Window.partitionBy(*key, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = by_value.withColumn("_upto", upto)
    at = lambda rank: F.min(F.when(F.col("_upto") >= F.col(rank), F.col("_v")))
    picked = ranked.groupBy(*key, "_i", "_at").agg(at("_first").alias("_a"), at("_second").alias("_z"))
    value = F.when(F.col("_a") == F.col("_z"), F.col("_a")).otherwise((F.ceil("_at") - F.col("_at")) * F.col("_a") + (F.col("_at") - F.floor("_at")) * F.col("_z"))
    lists = picked.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", value.alias("q")))), lambda x: x["q"]).alias("_q"))
    wide = lists.groupBy(*by).agg(*(F.max(F.when(F.col("_of") == n, F.col("_q"))).alias(n) for n in values))
    return joined(df.select(*by).distinct(), wide, by)
