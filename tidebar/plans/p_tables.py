"""Queries: sources, mutations of tables, and streams over the events."""

from __future__ import annotations

import uuid

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebar.plans.p_indicators import smoothed
from tidebar.plans.register import query
from tidebar.session import shared_folder
from tidebar.sources import partitions
from tidebar.sources import tables as io
from tidebar.sources.adapters import Tables
from tidebar.streaming import streams

KEYS = ["symbol", "timestamp"]
OLD = "SELECT symbol, timestamp, close, volume FROM bars WHERE day(timestamp) <= 20"
NEW = "SELECT symbol, timestamp, close * 2 AS close, volume + 1 AS volume FROM bars WHERE day(timestamp) >= 15"
C = {"old_rows": OLD, "new_rows": NEW}


def old(t: Tables):
    return t.bars.where(F.dayofmonth("timestamp") <= 20).select(*KEYS, "close", "volume")


def new(t: Tables):
    return t.bars.where(F.dayofmonth("timestamp") >= 15).select(*KEYS, (F.col("close") * 2).alias("close"), (F.col("volume") + 1).alias("volume"))


def scratch(t: Tables) -> str:
    """A new folder in the place that the session shares with its executors."""
    return f"{shared_folder(t.spark)}/{uuid.uuid4().hex}"


@query("scan_parquet", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def _(t: Tables):
    return io.read_table(t.spark, f"{t.folder}/part.parquet").select("p_partkey", "p_brand", "p_type", "p_size")


@query("scan_table", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t: Tables):
    name = f"scan_table_{uuid.uuid4().hex}"
    t.table("customer").createOrReplaceTempView(name)
    df = io.read_table(t.spark, name).select("c_custkey", "c_name", "c_acctbal")
    t.spark.catalog.dropTempView(name)  # the plan is resolved: the caller's session keeps no name of ours
    return df


@query("scan_json", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(t: Tables):
    path = f"{scratch(t)}/orders.json"
    df = t.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    df.write.json(path)
    return io.read_table(t.spark, path, df.schema)


@query("scan_csv_bars", "SELECT timestamp, 'VX' || right(symbol, 3) AS symbol, open, high, low, close AS settle, volume, open_interest FROM contract_bars")
def _(t: Tables):
    path = f"{scratch(t)}/futures.csv"
    label = F.concat(F.substring("symbol", -3, 1), F.lit(" ("), F.date_format("expiry_month", "MMM yyyy"), F.lit(")"))
    rows = t.contract_bars.select(F.date_format("timestamp", "MM/dd/yyyy"), label, "open", "high", "low", "close", "volume", "open_interest").toDF(*io.FUTURES_HEADER)
    early = F.col("Trade Date").rlike("^0[1-6]")
    io.to_csv(rows.where(early), f"{path}/early")
    turned = rows.where(~early).withColumn("Change", F.lit("0.1")).select("Change", *reversed(io.FUTURES_HEADER))  # another order, and a column more
    io.to_csv(turned, f"{path}/late")
    return io.read_futures_csv(t.spark, [f"{path}/early", f"{path}/late"])


@query("scan_csv_by_filename", "SELECT timestamp, symbol, open, high, low, close, volume FROM contract_bars")
def _(t: Tables):
    path = f"{scratch(t)}/contracts"
    rows = t.contract_bars.select("symbol", F.date_format("timestamp", "yyyy-MM-dd").alias("date"), "open", "high", "low", "close", F.col("volume").cast("double").alias("volume"))
    rows.withColumn("contract", F.col("symbol")).drop("symbol").write.partitionBy("contract").option("header", True).csv(path)
    return io.read_contract_dir(t.spark, path, r"contract=([A-Z]+[FGHJKMNQUVXZ]\d{2})/", recursive=True)


@query("export_symbol_series", "SELECT timestamp, close AS price FROM bars WHERE symbol = 'Brand#1'")
def _(t: Tables):
    path = f"{scratch(t)}/series.csv"
    io.to_csv(t.bars.where("symbol = 'Brand#1'").select("timestamp", F.col("close").alias("price")), path)
    return io.read_table(t.spark, path, T.StructType([T.StructField("timestamp", T.TimestampType()), T.StructField("price", T.DoubleType())]))


@query("append_table", "SELECT symbol, timestamp, close FROM old_rows UNION ALL SELECT symbol, timestamp, close FROM new_rows", C)
def _(t: Tables):
    path = f"{scratch(t)}/bars.parquet"
    io.append(old(t).select(*KEYS, "close"), path)
    io.append(new(t).select(*KEYS, "close"), path)
    return io.read_table(t.spark, path)


@query("replace_table", "SELECT symbol, timestamp, close FROM new_rows", C)
def _(t: Tables):
    path = f"{scratch(t)}/bars.parquet"
    io.append(old(t).select(*KEYS, "close"), path)
    io.replace(new(t).select(*KEYS, "close"), path)
    return io.read_table(t.spark, path)


@query("copy_query_to_csv", "SELECT symbol, count(*) AS n FROM bars GROUP BY symbol")
def _(t: Tables):
    path = f"{scratch(t)}/counts.csv"
    io.to_csv(t.bars.groupBy("symbol").agg(F.count("*").alias("n")), path)
    return io.read_table(t.spark, path, T.StructType([T.StructField("symbol", T.StringType()), T.StructField("n", T.LongType())]))


@query("upsert_by_key", "SELECT coalesce(n.symbol, o.symbol) AS symbol, coalesce(n.timestamp, o.timestamp) AS timestamp, CASE WHEN n.symbol IS NULL THEN o.close ELSE n.close END AS close, CASE WHEN n.symbol IS NULL THEN o.volume ELSE n.volume END AS volume FROM old_rows o FULL JOIN new_rows n ON o.symbol = n.symbol AND o.timestamp = n.timestamp", C)
def _(t: Tables):
    return io.upsert(old(t), new(t), KEYS)


@query("upsert_some_columns", "SELECT coalesce(n.symbol, o.symbol) AS symbol, coalesce(n.timestamp, o.timestamp) AS timestamp, CASE WHEN n.symbol IS NULL THEN o.close ELSE n.close END AS close, CASE WHEN o.symbol IS NULL THEN n.volume ELSE o.volume END AS volume FROM old_rows o FULL JOIN new_rows n ON o.symbol = n.symbol AND o.timestamp = n.timestamp", C)
def _(t: Tables):
    return io.upsert(old(t), new(t), KEYS, ["close"])


@query("insert_if_absent", "SELECT * FROM old_rows UNION ALL SELECT * FROM new_rows n WHERE NOT EXISTS (SELECT 1 FROM old_rows o WHERE o.symbol = n.symbol AND o.timestamp = n.timestamp)", C)
def _(t: Tables):
    return io.insert_new(old(t), new(t), KEYS)


@query("delete_then_insert_keys", "SELECT * FROM new_rows UNION ALL SELECT * FROM old_rows o WHERE NOT EXISTS (SELECT 1 FROM new_rows n WHERE o.symbol = n.symbol AND o.timestamp = n.timestamp)", C)
def _(t: Tables):
    return io.replace_keys(old(t), new(t), KEYS)


@query("replace_range", "SELECT * FROM old_rows WHERE NOT (symbol = 'Brand#1' AND timestamp BETWEEN '1996-01-01' AND '1996-12-31') UNION ALL SELECT * FROM new_rows WHERE symbol = 'Brand#1' AND timestamp BETWEEN '1996-01-01' AND '1996-12-31'", C)
def _(t: Tables):
    inside = F.expr("symbol = 'Brand#1' AND timestamp BETWEEN timestamp'1996-01-01' AND timestamp'1996-12-31'")
    return io.replace_range(old(t), new(t).where(inside), inside)


@query("upsert_partitioned", "SELECT coalesce(n.symbol, o.symbol) AS symbol, coalesce(n.timestamp, o.timestamp) AS timestamp, CASE WHEN n.symbol IS NULL THEN o.close ELSE n.close END AS close, CASE WHEN n.symbol IS NULL THEN o.volume ELSE n.volume END AS volume FROM old_rows o FULL JOIN (SELECT * FROM new_rows WHERE year(timestamp) = 1997) n ON o.symbol = n.symbol AND o.timestamp = n.timestamp", C)
def _(t: Tables):
    path, months = f"{scratch(t)}/bars", partitions.by_month()
    partitions.create(old(t), path, months)
    partitions.upsert_table(new(t).where(F.year("timestamp") == 1997), path, KEYS, months)
    return partitions.read(t.spark, path, months).select(*KEYS, "close", "volume")


@query("replace_range_partitioned", "SELECT * FROM old_rows WHERE NOT (symbol = 'Brand#1' AND timestamp BETWEEN '1996-02-10' AND '1996-11-20') UNION ALL SELECT * FROM new_rows WHERE symbol = 'Brand#1' AND timestamp BETWEEN '1996-02-10' AND '1996-11-20'", C)
def _(t: Tables):
    path, months, own = f"{scratch(t)}/bars", partitions.by_month(), F.col("symbol") == "Brand#1"
    partitions.create(old(t), path, months)
    staged = new(t).where(own & F.col("timestamp").between("1996-02-10", "1996-11-20"))
    partitions.replace_range_table(staged, path, "1996-02-10", "1996-11-20", months, own)
    return partitions.read(t.spark, path, months).select(*KEYS, "close", "volume")


@query("align_to_schema", "SELECT timestamp, symbol, open, high, low, close, volume, source, interval_value, interval_unit, false AS adjusted, quality FROM bars")
def _(t: Tables):
    return io.align(t.bars.withColumn("adjusted", F.lit(False)).withColumn("extra", F.lit(1)), io.BAR_SCHEMA)


@query("standardise_vendor_bars", "SELECT timestamp, symbol, open, high, low, close, close AS settle, volume, up_volume, down_volume, 'vendor' AS source, 1 AS interval_value, 'daily' AS interval_unit, false AS adjusted, 100 AS quality FROM bars")
def _(t: Tables):
    fields = ("symbol", "timestamp", "open", "high", "low", "close", "volume", "up_volume", "down_volume")
    vendor = t.bars.select(*(F.col(c).cast("string") for c in fields)).toDF("Ticker", "TimeStamp", "Open", "High", "Low", "Close", "TotalVolume", "UpVolume", "DownVolume")
    return io.standardise(vendor, F.col("Ticker"), "daily", 1, "vendor")


@query("flatten_account_json", "SELECT 'A' || account_id || '_' || symbol AS position_id, 'A' || account_id AS account_id, symbol, quantity::DOUBLE AS quantity, 0.0::DOUBLE AS average_price, market_value, unrealized_pnl, timestamp FROM positions")
def _(t: Tables):
    payload = F.to_json(
        F.struct(
            F.concat(F.lit("A"), F.col("account_id").cast("string")).alias("AccountID"), F.col("symbol").alias("Symbol"), F.col("quantity").cast("string").alias("Quantity"), F.lit("n/a").alias("AveragePrice"),
            F.col("market_value").cast("string").alias("MarketValue"), F.col("unrealized_pnl").cast("string").alias("UnrealizedProfitLoss"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("TimeStamp"),
        )
    )
    return io.normalise_account(t.positions.select(payload.alias("payload")), "positions")


@query("flatten_account_orders", """SELECT timestamp, 'A' || account_id AS account_id, CAST(order_id AS VARCHAR) AS order_id, '' AS symbol, amount AS quantity, '' AS order_type, '' AS side, status, 0.0::DOUBLE AS limit_price, 0.0::DOUBLE AS stop_price, CASE WHEN status = 'Filled' THEN amount ELSE 0 END AS filled_quantity, 0.0::DOUBLE AS remaining_quantity,
    0.0::DOUBLE AS average_fill_price, 'DAY' AS duration, '' AS route, CASE WHEN status = 'Filled' THEN timestamp END AS execution_time, NULL::TIMESTAMP AS cancellation_time FROM acct_orders""")
def _(t: Tables):
    filled = F.col("status") == "Filled"
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    payload = F.struct(
        F.concat(F.lit("A"), F.col("account_id").cast("string")).alias("AccountID"), F.col("order_id").cast("string").alias("OrderID"), F.col("amount").cast("string").alias("Quantity"), F.col("status").alias("Status"),
        F.when(filled, F.col("amount").cast("string")).alias("FilledQuantity"), F.lit("DAY").alias("Duration"), F.when(filled, time).otherwise("not yet").alias("ExecutionTime"), time.alias("Time"),
    )
    return io.normalise_account(t.acct_orders.select(F.to_json(payload).alias("payload")), "orders")


@query("flatten_account_trades", """SELECT timestamp AS trade_time, 'A' || account_id AS account_id, CAST(order_id AS VARCHAR) AS order_id, 'T' || order_id AS trade_id, '' AS symbol, 1.0::DOUBLE AS quantity, amount AS price, 'Buy' AS side, 0.0::DOUBLE AS commission, 0.5::DOUBLE AS fees, '' AS position_effect FROM acct_orders WHERE status = 'Filled'""")
def _(t: Tables):
    payload = F.struct(
        F.concat(F.lit("A"), F.col("account_id").cast("string")).alias("AccountID"), F.col("order_id").cast("string").alias("OrderID"), F.concat(F.lit("T"), F.col("order_id").cast("string")).alias("TradeID"), F.lit("1").alias("Quantity"),
        F.col("amount").cast("string").alias("Price"), F.lit("Buy").alias("Side"), F.lit("").alias("Commission"), F.lit("0.5").alias("Fees"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("TradeTime"),
    )
    return io.normalise_account(t.acct_orders.where("status = 'Filled'").select(F.to_json(payload).alias("payload")), "trades")


@query("normalise_observations", "SELECT indicator, timestamp, value FROM econ WHERE month(timestamp) % 5 <> 0")
def _(t: Tables):
    raw = t.econ.select("indicator", F.date_format("timestamp", "yyyy-MM-dd").alias("date"), F.when(F.month("timestamp") % 5 == 0, ".").otherwise(F.col("value").cast("string")).alias("value"))
    return io.normalise_obs(raw)


SPEC = {
    "id": {"type": "int", "required": True}, "symbol": {"upper": True}, "price": {"type": "double", "min": 10.0, "max": 90.0},
    "flag": {"type": "boolean"}, "kind": {"allowed": ["click", "view"], "default": "other"},
}


def raw_ticks(t: Tables):
    return t.ticks.select("id", "symbol", F.col("close").cast("string").alias("px"), F.when(F.col("id") % 2 == 0, "yes").otherwise("off").alias("flag"), F.col("symbol").alias("kind"))


@query("normalise_to_spec", """SELECT id, upper(symbol) AS symbol, least(greatest(close, 10.0), 90.0) AS price, id % 2 = 0 AS flag, CASE WHEN symbol IN ('click', 'view') THEN symbol ELSE 'other' END AS kind FROM ticks""")
def _(t: Tables):
    return io.normalise(raw_ticks(t), SPEC, {"px": "price"})


@query("normalise_metrics", """SELECT count(*) AS rows_in, count(*) FILTER (id % 7 <> 0) AS rows_out, count(*) FILTER (symbol NOT IN ('click', 'view')) AS missing_filled, count(*) FILTER (close < 10 OR close > 90) AS outliers_corrected, count(*) FILTER (symbol NOT IN ('click', 'view')) + count(*) FILTER (id % 7 = 0) AS invalid_cells FROM ticks""")
def _(t: Tables):
    seen = Observation("normalise")
    raw = raw_ticks(t).withColumn("id", F.when(F.col("id") % 7 == 0, "n/a").otherwise(F.col("id").cast("string")))
    io.append(io.normalise(raw, SPEC, {"px": "price"}, seen), f"{scratch(t)}/ticks")  # the rows, and what was done to them, by one job
    return t.spark.createDataFrame([tuple(seen.get[c] for c in io.NORMALISE_METRICS)], ", ".join(f"{c} long" for c in io.NORMALISE_METRICS))


@query("coerce_scraped_table", "SELECT symbol, timestamp, close FROM bars WHERE symbol IN ('Brand#1', 'Brand#2') AND timestamp BETWEEN '1996-01-01' AND '1997-12-31'")
def _(t: Tables):
    raw = t.bars.select(*(F.col(c).cast("string") for c in ("symbol", "timestamp", "close")))
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("timestamp", T.TimestampType()), T.StructField("close", T.DoubleType())])
    return io.coerce_scraped(raw, schema, ["Brand#1", "Brand#2"], "1996-01-01", "1997-12-31")


@query("econ_revisions", "SELECT indicator, timestamp, CASE WHEN month(timestamp) % 3 = 0 THEN value + 1 ELSE value END AS value, CASE WHEN month(timestamp) % 3 = 0 THEN 1 ELSE 0 END AS revision_number FROM econ")
def _(t: Tables):
    revised = t.econ.where(F.month("timestamp") % 2 == 1).select("indicator", "timestamp", F.when(F.month("timestamp") % 3 == 0, F.col("value") + 1).otherwise(F.col("value")).alias("value"))
    later = t.econ.where((F.month("timestamp") % 2 == 0) & (F.month("timestamp") % 3 == 0)).select("indicator", "timestamp", (F.col("value") + 1).alias("value"))
    return io.apply_revisions(t.econ, revised.unionByName(later))


@query("incremental_start", "SELECT s.symbol, u AS interval_unit, coalesce(CASE WHEN u = 'daily' THEN m::DATE + 1 END, DATE '2002-01-01' - 90) AS start FROM (SELECT symbol, max(timestamp) AS m FROM bars GROUP BY symbol) s, (VALUES ('daily'), ('minute')) v(u)")
def _(t: Tables):
    wanted = t.bars.select("symbol").distinct().withColumn("interval_unit", F.explode(F.array(F.lit("daily"), F.lit("minute"))))
    return io.next_start(t.bars, wanted, "2002-01-01")


@query("retag_source", "SELECT symbol, timestamp, CASE WHEN regexp_matches(symbol, '#1[0-9]$') THEN 'retagged' ELSE source END AS source FROM bars")
def _(t: Tables):
    return io.retag_source(t.bars, "#1[0-9]$", "retagged").select("symbol", "timestamp", "source")


@query("delete_by_predicate", "SELECT symbol, timestamp, source FROM bars WHERE NOT (symbol LIKE 'Brand#2%' AND source = 'R')")
def _(t: Tables):
    return io.delete_where(t.bars, F.col("symbol").like("Brand#2%") & (F.col("source") == "R")).select("symbol", "timestamp", "source")


@query("standardise_interval_unit", "SELECT symbol, timestamp, 'daily' AS interval_unit FROM bars")
def _(t: Tables):
    mixed = t.bars.withColumn("interval_unit", F.when(F.dayofmonth("timestamp") % 2 == 0, "day").otherwise("daily"))
    return io.standardise_units(mixed).select("symbol", "timestamp", "interval_unit")


@query("populate_symbol_metadata", "SELECT symbol, u AS interval_unit, CAST(v AS INT) AS interval_value, CASE WHEN symbol LIKE 'Brand#1%' THEN 'first' ELSE 'second' END AS source FROM (SELECT DISTINCT symbol FROM bars), (VALUES ('daily', 1), ('minute', 15)) w(u, v)")
def _(t: Tables):
    groups = t.bars.select("symbol").distinct()
    of = lambda df, source, priority: df.select(F.lit(source).alias("source"), F.lit(priority).alias("priority"), F.array("symbol").alias("symbols"), F.array(F.lit("1D"), F.lit("15min")).alias("frequencies"))
    return io.build_metadata(of(groups.where(F.col("symbol").like("Brand#1%")), "first", 1).unionByName(of(groups, "second", 2)))


@query("tolerant_select", "SELECT symbol, timestamp, close, 0 AS open_interest, 'none' AS note FROM bars")
def _(t: Tables):
    return io.ensure_columns(t.bars.select("symbol", "timestamp", "close"), {"close": 0.0, "open_interest": 0, "note": "none"})


def tick_stream(t: Tables):
    """The events as a stream of ticks, from their Parquet file."""
    raw = t.table("events")
    stream = t.spark.readStream.schema(raw.schema).option("pathGlobFilter", "*.parquet").parquet(f"{t.folder}/events.parquet*")
    value = F.col("value")
    return stream.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_id").alias("id"), *(value.alias(c) for c in ("open", "high", "low", "close")), F.lit(1).cast("long").alias("volume"))


def drained(t: Tables, result):
    folder = scratch(t)
    return streams.drained(result, f"{folder}/checkpoint", f"{folder}/out")


_BAR = "arg_min(open, {'a': timestamp, 'b': id}) AS open, max(high) AS high, min(low) AS low, arg_max(close, {'a': timestamp, 'b': id}) AS close, CAST(sum(volume) AS BIGINT) AS volume"


@query("stream_bars", f"SELECT symbol, time_bucket(INTERVAL 5 MINUTE, timestamp) AS timestamp, {_BAR} FROM ticks GROUP BY symbol, time_bucket(INTERVAL 5 MINUTE, timestamp) HAVING time_bucket(INTERVAL 5 MINUTE, any_value(timestamp)) + INTERVAL 5 MINUTE <= (SELECT max(timestamp) - INTERVAL 10 MINUTE FROM ticks)")
def _(t: Tables):
    return drained(t, streams.stream_bars(tick_stream(t)))


@query("stream_dedupe", "SELECT DISTINCT symbol, day FROM (SELECT symbol, strftime(timestamp, '%Y-%m-%d') AS day FROM ticks)")
def _(t: Tables):
    keyed = tick_stream(t).withColumn("day", F.date_format("timestamp", "yyyy-MM-dd"))
    return drained(t, streams.stream_dedupe(keyed, ["symbol", "day"], "40 days")).select("symbol", "day")


@query("stream_validate", "SELECT symbol, id, 'cheap' AS rule, 'close' AS field FROM ticks WHERE NOT (close > 30) UNION ALL SELECT symbol, id, 'dear' AS rule, 'high' AS field FROM ticks WHERE NOT (high < 80)")
def _(t: Tables):
    return drained(t, streams.stream_validate(tick_stream(t), {"cheap": ("close > 30", "close"), "dear": ("high < 80", "high")}, ["symbol", "id"]))


@query("stream_upsert", "SELECT symbol, day, arg_max(close, {'a': timestamp, 'b': id}) AS close FROM (SELECT *, strftime(timestamp, '%Y-%m-%d') AS day FROM ticks) GROUP BY symbol, day")
def _(t: Tables):
    folder = scratch(t)
    daily = tick_stream(t).select("symbol", F.date_format("timestamp", "yyyy-MM-dd").alias("day"), "timestamp", "id", "close")
    streams.stream_upsert(daily, ["symbol", "day"], f"{folder}/state", f"{folder}/checkpoint", ["timestamp", "id"]).awaitTermination()
    return streams.latest_state(t.spark, f"{folder}/state").select("symbol", "day", "close")


@query("stream_ema", "SELECT symbol, k.t AS timestamp, close, round(e, 6) AS ema FROM stream_means", {"stream_ticks": "SELECT symbol, {'t': timestamp, 'id': id} AS k, close FROM ticks", "stream_means": smoothed("stream_ticks", "close", 2 / 21, "k", "k")})
def _(t: Tables):
    folder = scratch(t)
    with streams.rocks(t.spark):
        return streams.drained(streams.stream_ema(tick_stream(t)), f"{folder}/checkpoint", f"{folder}/out").withColumn("ema", F.round("ema", 6))
