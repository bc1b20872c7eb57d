"""Structured Streaming forms of the incremental batch operations."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidebar.sources.tables import upsert


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files: int = 1) -> DataFrame:
    """Parquet files as a stream, so many files to a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def stream_bars(stream: DataFrame, width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Tumbling bars of ticks (symbol, timestamp, id, open, high, low, close, volume); rows later than delay are dropped.

    For the append mode: a bar is given once the watermark has passed it.
    """
    order = F.struct("timestamp", "id")
    bars = stream.withWatermark("timestamp", delay).groupBy("symbol", F.window("timestamp", width)).agg(
        F.min_by("open", order).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", order).alias("close"), F.sum("volume").alias("volume")
    )
    return bars.select("symbol", F.col("window.start").alias("timestamp"), "open", "high", "low", "close", "volume")


def stream_dedupe(stream: DataFrame, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """The first row of each key; keys are remembered for the delay."""
    return stream.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(keys)


def stream_validate(stream: DataFrame, rules: dict[str, tuple[str, str]], keys: list[str]) -> DataFrame:
    """A row for each rule that a row breaks, with counts of rows as an observed metric of each batch."""
    failed = F.array_compact(F.array(*(F.when(F.expr(f"NOT ({cond})"), F.struct(F.lit(name).alias("rule"), F.lit(column).alias("field"))) for name, (cond, column) in rules.items())))
    checked = stream.withColumn("_failed", failed).observe("validation", F.count(F.lit(1)).alias("n"), F.count_if(F.size("_failed") > 0).alias("bad"))
    return checked.select(*keys, F.inline("_failed"))


#: Parts of a state, by a hash of the key; a batch writes those anew that it touches.
BUCKETS = 64
MANIFEST = "manifest.json"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _manifest(spark: SparkSession, path: str) -> dict:
    """Of the newest version: its number, the version of each bucket, and of each bucket before it; nothing before the first."""
    fs, place = _file_system(spark, f"{path}/{MANIFEST}")
    if not fs.exists(place):
        return {"version": -1, "buckets": {}, "before": {}}
    stream = fs.open(place)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return {"version": found["version"], **{k: {int(b): v for b, v in found[k].items()} for k in ("buckets", "before")}}


def _put_manifest(spark: SparkSession, path: str, found: dict) -> None:
    """In place of the last one, by a rename over it."""
    fs, draft = _file_system(spark, f"{path}/{MANIFEST}.{found['version']}")
    stream = fs.create(draft, True)
    try:
        stream.write(json.dumps(found).encode())
    finally:
        stream.close()
    jvm = spark._jvm
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    draft = fs.makeQualified(draft)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, jvm.org.apache.hadoop.fs.Path(draft.getParent(), MANIFEST), over)


def _read(spark: SparkSession, path: str, chosen: dict[int, int]) -> DataFrame:
    """The rows of buckets at versions; at most BUCKETS folders."""
    return spark.read.parquet(*(f"{path}/_version={v}/_bucket={b}" for b, v in sorted(chosen.items())))


def upsert_batch(batch: DataFrame, number: int, keys: list[str], path: str, order: list[str] | None = None) -> None:
    """One batch into the state under path.

    The buckets that it touches are written anew under its number, and then the manifest says so, all at once: it is
    all that a batch or a reader looks up, however many versions there have been. A batch that is run again after a failure
    finds what was there before it, and gives the same state; what neither the state nor the one before it needs goes.
    """
    spark, values = batch.sparkSession, [c for c in batch.columns if c not in keys]
    batch = batch.persist()
    try:
        newest = batch.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*(order or values))).alias("_v")).select(*keys, "_v.*")
        bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
        touched = [r[0] for r in batch.select(bucket.alias("b")).distinct().collect()]  # BUCKETS at most
        if not touched:
            return
        found = _manifest(spark, path)
        known = found["before"] if found["version"] >= number else found["buckets"]
        before = {b: known[b] for b in touched if b in known}
        state = upsert(_read(spark, path, before), newest, keys) if before else newest
        state.select(*batch.columns, bucket.alias("_bucket")).write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/_version={number}")
        now = {**known, **dict.fromkeys(touched, number)}
        _put_manifest(spark, path, {"version": number, "buckets": now, "before": known})
    finally:
        batch.unpersist()
    needed = {*now.items(), *known.items()}
    for b, v in {*found["before"].items(), *found["buckets"].items()} - needed:
        _remove(spark, path, b, v, {w for _, w in needed})


def _remove(spark: SparkSession, path: str, bucket: int, version: int, needed: set[int]) -> None:
    """A bucket's folder of a version, or the whole version if no bucket needs it."""
    fs, place = _file_system(spark, f"{path}/_version={version}" + (f"/_bucket={bucket}" if version in needed else ""))
    fs.delete(place, True)


def stream_upsert(stream: DataFrame, keys: list[str], path: str, checkpoint: str, order: list[str] | None = None) -> StreamingQuery:
    """Each batch upserted into the newest state under path; a later correction wins.

    The state lies in BUCKETS parts by a hash of the key, see upsert_batch(). Within a batch the last row of a key by `order` counts.
    """

    def apply(batch: DataFrame, number: int) -> None:
        upsert_batch(batch, number, keys, path, order)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest state that stream_upsert has written."""
    return _read(spark, path, _manifest(spark, path)["buckets"])


@contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """RocksDB for the state of streams that start within, as their processors need; the session's own setting comes back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, was)


class EmaProcessor(StatefulProcessor):
    """Carries one mean for each key over the batches; rows are in order of time within a batch."""

    def __init__(self, alpha: float):
        self.alpha = alpha

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mean = handle.getValueState("mean", "mean double")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        df = pd.concat(list(rows), ignore_index=True).sort_values(["timestamp", "id"], kind="stable")
        mean = self.mean.get()[0] if self.mean.exists() else None
        out = []
        for value in df["close"]:
            if value == value:
                mean = value if mean is None else mean + self.alpha * (value - mean)
            out.append(mean)
        if mean is not None:
            self.mean.update((mean,))
        df["ema"] = out
        yield df[["symbol", "timestamp", "close", "ema"]]

    def close(self) -> None:
        pass


def stream_ema(stream: DataFrame, span: int = 20) -> DataFrame:
    """Exponential means that go on from batch to batch; late rows are smoothed when they come."""
    return (
        stream.select("symbol", "timestamp", "id", "close")
        .groupBy("symbol")
        .transformWithStateInPandas(EmaProcessor(2.0 / (span + 1)), "symbol string, timestamp timestamp, close double, ema double", "append", "none")
    )


def drained(result: DataFrame, checkpoint: str, path: str, mode: str = "append") -> DataFrame:
    """All that a stream gives for the data that is there, by way of Parquet files."""
    query = result.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return result.sparkSession.read.schema(result.schema).parquet(path)
