"""Operators whose plan is the point: pairs in blocks, scans in slices, order statistics without buffers."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidebar.functions import quantiles
from tidebar.operators import pairs, risk, scans


def returns(spark, symbols, days, seed=0, missing=0.1):
    rng = np.random.default_rng(seed)
    market = rng.normal(0, 0.01, days)
    wide = market[:, None] * rng.uniform(0, 2, symbols) + rng.normal(0, 0.01, (days, symbols))
    df = pd.DataFrame(wide, index=pd.date_range("2020-01-01", periods=days), columns=[f"S{k:05d}" for k in range(symbols)])
    long = df.stack().rename("ret").rename_axis(["timestamp", "symbol"]).reset_index()
    return df, spark.createDataFrame(long[rng.random(len(long)) >= missing])


@pytest.mark.parametrize("block, chunk", [(1000, 1024), (3, 7), (1, 1)])
def test_pairs_in_blocks_are_all_pairs(spark, block, chunk):
    _, rows = returns(spark, 9, 20)
    rows = rows.unionByName(rows.limit(1).withColumn("symbol", F.lit(None).cast("string")))
    got = pairs.pairs_by_date(rows, "ret", True, block=block, chunk=chunk).collect()
    known = {(r["symbol"], r["timestamp"]): r["ret"] for r in rows.where("symbol IS NOT NULL").collect()}
    want = sorted((a, b, x, y) for (a, s), x in known.items() for (b, t), y in known.items() if s == t and a <= b)
    assert sorted(map(tuple, got)) == want
    assert pairs.pairs_by_date(rows, "ret", block=block, chunk=chunk).count() == sum(a < b for a, b, _, _ in want)


def test_correlation_of_two_thousand_symbols(spark):
    wide, rows = returns(spark, 2000, 12, missing=0.0)
    out = risk.correlation(rows)
    plan = out._jdf.queryExecution().toString()
    assert "repartition" in plan.lower() and "CartesianProduct" not in plan
    got = out.agg(F.count("*").alias("n"), F.avg("correlation").alias("mean"), F.sum(F.col("correlation") * F.xxhash64("symbol", "other") % 1000).alias("s")).first()
    assert got["n"] == 2000 * 2001 // 2
    exact = np.corrcoef(wide.to_numpy().T)
    assert got["mean"] == pytest.approx(exact[np.triu_indices(2000)].mean(), abs=1e-6)
    some = {(r["symbol"], r["other"]): r["correlation"] for r in out.where("symbol = 'S00007' AND other < 'S00050'").collect()}
    assert len(some) == 43 and all(abs(v - exact[7, int(o[1:])]) < 1e-5 for (_, o), v in some.items())


def series(spark, n=600, seed=3):
    """Two symbols and a null one over two years, with nulls, and rows without a time."""
    rng = np.random.default_rng(seed)
    days = pd.to_datetime("2020-01-01") + pd.to_timedelta(rng.permutation(800)[:n], unit="D")
    rows = [(["A", "B", None][rng.integers(0, 3)], d.to_pydatetime(), None if rng.random() < 0.3 else round(float(rng.normal()), 3)) for d in days]
    return spark.createDataFrame([*rows, ("A", None, 5.0)], "symbol string, timestamp timestamp, x double")


@pytest.mark.parametrize("falling", [False, True])
@pytest.mark.parametrize("part", [None, F.lit])
def test_running_values_in_slices_equal_one_window(spark, falling, part):
    df = series(spark)
    w = Window.partitionBy("symbol").orderBy(F.col("timestamp").desc() if falling else F.col("timestamp").asc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = {"sum": F.sum("x"), "product": F.product("x"), "max": F.max("x"), "min": F.min("x"), "last": F.last("x", ignorenulls=True)}
    want = df.withColumns({k: c.over(w) for k, c in whole.items()})
    got = scans.running(df, {k: (k, F.col("x")) for k in whole}, falling=falling, part=part(1) if part else None)
    key = lambda r: (str(r["symbol"]), str(r["timestamp"]))
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key)):
        assert key(a) == key(b) and all((a[k] is None) == (b[k] is None) and (a[k] is None or a[k] == pytest.approx(b[k], rel=1e-9, abs=1e-9)) for k in whole)


def test_one_long_series_is_more_than_one_task(spark):
    n = 40_000
    df = spark.range(n).select(F.lit("A").alias("symbol"), F.timestamp_seconds(F.lit(1_500_000_000) + F.col("id") * 3600).alias("timestamp"), (F.col("id") % 1000).cast("double").alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scans.running(df, {"peak": ("max", F.col("x"))})
        tasks = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < n and out.agg(F.sum("peak")).first()[0] == sum(min(i, 999) for i in range(n))


def test_percentiles_without_a_buffer_are_exact(spark):
    rng = np.random.default_rng(5)
    frames = [("A", rng.normal(size=5000)), ("B", np.r_[np.zeros(3000), rng.integers(0, 5, 2000)]), ("C", [1.5]), (None, rng.normal(size=7)), ("D", [None, None]), ("E", [1.0, None, 2.0])]
    rows = [(s, None if v is None else float(v), i) for s, values in frames for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "symbol string, x double, i int")
    shares = [0.0, 0.05, 0.25, 0.5, 0.999, 1.0]
    values = {"q": F.col("x"), "other": F.col("i")}
    want = {r["symbol"]: r for r in quantiles.percentiles(df, ["symbol"], values, shares).collect()}
    for accuracy in (quantiles.ACCURACY, 3):  # a poor sketch gives brackets that fail
        plan = quantiles.percentiles(df, ["symbol"], values, shares, buffered=0)
        assert "percentile(" not in plan._jdf.queryExecution().optimizedPlan().toString()
        quantiles.ACCURACY, was = accuracy, quantiles.ACCURACY
        got = {r["symbol"]: r for r in quantiles.percentiles(df, ["symbol"], values, shares, buffered=0).collect()}
        quantiles.ACCURACY = was
        assert got.keys() == want.keys()
        for s in want:
            for name in values:
                assert (got[s][name] is None) == (want[s][name] is None) and (got[s][name] is None or got[s][name] == pytest.approx(want[s][name], abs=1e-12)), (s, name, accuracy)
