"""Mutations of tables as functions of DataFrames, and readers and writers.

A table format with transactions is not assumed: an upsert gives the whole new
state, to be written to a new place. partitions.py changes a table where it lies.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The canonical bars.
BAR_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        *(T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close")),
        T.StructField("volume", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("interval_value", T.IntegerType()),
        T.StructField("interval_unit", T.StringType()),
        T.StructField("adjusted", T.BooleanType()),
        T.StructField("quality", T.IntegerType()),
    ]
)


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], update: list[str] | None = None) -> DataFrame:
    """Insert or update by key: incoming values win in the columns of update (all, if not given; none: existing rows stay).

    One shuffle of the union by key. A key that incoming repeats counts once.
    """
    columns = existing.columns
    values = [c for c in columns if c not in keys]
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.select(*columns).withColumn("_new", F.lit(1)))
    first, last = F.min_by(F.struct(*values), "_new"), F.max_by(F.struct(*values), "_new")
    merged = both.groupBy(*keys).agg(first.alias("_old"), last.alias("_last"))
    chosen = values if update is None else update
    return merged.select(*keys, *(F.col(f"{'_last' if c in chosen else '_old'}.{c}").alias(c) for c in values)).select(*columns)


def insert_new(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows, and incoming rows whose key is new."""
    fresh = incoming.join(existing.select(*keys).distinct(), keys, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def replace_keys(existing: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of staged keys are deleted, then the staged rows inserted."""
    return existing.join(staged.select(*keys).distinct(), keys, "left_anti").unionByName(staged.select(*existing.columns))


def replace_range(existing: DataFrame, incoming: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition give way to the incoming ones."""
    return existing.where(~F.coalesce(condition, F.lit(False))).unionByName(incoming.select(*existing.columns))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~F.coalesce(condition, F.lit(False)))


def append(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def to_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet, JSON or CSV path, or a table of the catalog."""
    reader = spark.read.schema(schema) if schema else spark.read
    for ending, read in ((".parquet", reader.parquet), (".json", reader.json), (".csv", reader.option("header", True).csv)):
        if name.rstrip("/").endswith(ending):
            return read(name)
    return spark.table(name)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema in its order and types: others are dropped, a missing timestamp is the present, other missing ones an error."""
    missing = [f.name for f in schema if f.name not in df.columns and f.name != "timestamp"]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*((F.col(f.name) if f.name in df.columns else F.current_timestamp()).cast(f.dataType).alias(f.name) for f in schema))


def ensure_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def standardise(df: DataFrame, symbol: str | Column, unit: str, value: int, source: str) -> DataFrame:
    """Vendor bars to canonical ones: headers are matched by what they contain, settle stands in for a missing close."""
    wanted = {"timestamp": ("timestamp", "date", "time"), "open": ("open",), "high": ("high",), "low": ("low",), "close": ("close",), "settle": ("settle",), "volume": ("totalvolume", "volume"), "up_volume": ("upvolume",), "down_volume": ("downvolume",)}
    names = {c.lower().replace(" ", "").replace("_", ""): c for c in df.columns}

    def found(parts: tuple[str, ...]) -> str | None:
        for p in parts:
            exact = [c for n, c in names.items() if n == p]
            loose = [c for n, c in names.items() if p in n and not (p == "open" and "interest" in n) and not (p == "volume" and n[:2] in ("up", "do"))]
            if exact or loose:
                return (exact or loose)[0]
        return None

    at = {k: found(v) for k, v in wanted.items()}
    col = lambda k, kind: F.col(f"`{at[k]}`").try_cast(kind) if at[k] else F.lit(None).cast(kind)
    close = F.coalesce(col("close", "double"), col("settle", "double"))
    return df.select(
        col("timestamp", "timestamp").alias("timestamp"), (F.lit(symbol) if isinstance(symbol, str) else symbol).alias("symbol"),
        *(col(c, "double").alias(c) for c in ("open", "high", "low")), close.alias("close"), F.coalesce(col("settle", "double"), close).alias("settle"),
        *(col(c, "double").cast("long").alias(c) for c in ("volume", "up_volume", "down_volume")),
        F.lit(source).alias("source"), F.lit(value).alias("interval_value"), F.lit(unit).alias("interval_unit"), F.lit(False).alias("adjusted"), F.lit(100).alias("quality"),
    )


def standardise_units(df: DataFrame) -> DataFrame:
    return df.withColumn("interval_unit", F.when(F.col("interval_unit") == "day", "daily").otherwise(F.col("interval_unit")))


def retag_source(df: DataFrame, pattern: str, source: str, seen: Observation | None = None) -> DataFrame:
    """Another source for the symbols that match; seen: gets how many rows there are (rows) and have changed (changed), once a job has run over the result."""
    hit = F.coalesce(F.col("symbol").rlike(pattern), F.lit(False))
    if seen is not None:
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(hit & ~F.col("source").eqNullSafe(F.lit(source))).alias("changed"))
    return df.withColumn("source", F.when(hit, source).otherwise(F.col("source")))


def normalise_obs(df: DataFrame) -> DataFrame:
    """Observations of an indicator: a point stands for no value, and rows without one go."""
    return df.select("indicator", F.col("date").try_cast("timestamp").alias("timestamp"), F.col("value").try_cast("double").alias("value")).dropna(subset=["timestamp", "value"])


def apply_revisions(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New values replace known ones that differ and raise their revision number; new observations are added."""
    n = new.select("indicator", "timestamp", F.col("value").alias("new_value"))
    both = existing.join(n, ["indicator", "timestamp"], "full_outer")
    changed = F.col("new_value").isNotNull() & F.col("value").isNotNull() & (F.col("new_value") != F.col("value"))
    return both.select(
        "indicator", "timestamp", F.coalesce("new_value", "value").alias("value"), (F.coalesce("revision_number", F.lit(0)) + F.when(changed, 1).otherwise(0)).alias("revision_number")
    )


def next_start(bars: DataFrame, wanted: DataFrame, today: str, default_days: int = 90) -> DataFrame:
    """Where the next load of each wanted (symbol, interval_unit) begins: the day after its newest row, else so many days back."""
    newest = bars.groupBy("symbol", "interval_unit").agg(F.date_add(F.max("timestamp"), 1).alias("start"))
    return wanted.join(newest, ["symbol", "interval_unit"], "left").withColumn("start", F.coalesce("start", F.date_sub(F.lit(today).cast("date"), default_days)))


#: What normalise() counts: rows in and out, cells that were missing and got a default, numbers put at a bound, and cells that do not fit their type or the allowed values.
NORMALISE_METRICS = ("rows_in", "rows_out", "missing_filled", "outliers_corrected", "invalid_cells")


def normalise(df: DataFrame, spec: dict[str, dict], mapping: dict[str, str] | None = None, seen: Observation | None = None) -> DataFrame:
    """Spec-driven cleaning: per field type, required, min, max, upper, lower, allowed and default.

    seen: gets NORMALISE_METRICS from the job that runs over the result, without a pass of its own.
    """
    for old, new in (mapping or {}).items():
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    out, filled, held, invalid = [], [], [], []
    for name, rule in spec.items():
        kind = rule.get("type", "string")
        raw = c = F.col(name) if name in df.columns else F.lit(None)
        if kind == "boolean":
            word = F.lower(F.trim(c.cast("string")))
            c = F.when(word.isin("yes", "y", "1", "true", "t", "on"), True).when(word.isin("no", "n", "0", "false", "f", "off"), False)
        elif kind == "int":
            c = c.try_cast("double").try_cast("long")
        else:
            c = c.cast("string").try_cast(kind) if kind != "string" else c.cast("string")
        bound = lambda x: F.lit(rule[x]).cast("double" if kind == "double" else "long")  # noqa: B023, E731
        outside = F.lit(False)
        if "min" in rule:
            outside = outside | (c < bound("min"))
        if "max" in rule:
            outside = outside | (c > bound("max"))
        held.append(outside)
        if "min" in rule:
            c = F.when(c.isNotNull(), F.greatest(c, bound("min")))
        if "max" in rule:
            c = F.when(c.isNotNull(), F.least(c, bound("max")))
        c = F.upper(c) if rule.get("upper") else F.lower(c) if rule.get("lower") else c
        if "allowed" in rule:
            c = F.when(c.isin(rule["allowed"]), c)
        invalid.append(raw.isNotNull() & c.isNull())
        if "default" in rule:
            filled.append(c.isNull())
            c = F.coalesce(c, F.lit(rule["default"]))
        out.append(c.alias(name))
    required = [n for n, rule in spec.items() if rule.get("required")]
    if seen is None:
        result = df.select(*out)
        return result.dropna(subset=required) if required else result
    total = lambda flags: sum((F.when(f, 1).otherwise(0) for f in flags), F.lit(0)).cast("long")
    counted = df.select(*out, *(total(flags).alias(n) for flags, n in ((filled, "_filled"), (held, "_held"), (invalid, "_invalid"))))
    whole = F.lit(True)
    for name in required:
        whole = whole & F.col(name).isNotNull()
    added = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("_filled", "missing_filled"), ("_held", "outliers_corrected"), ("_invalid", "invalid_cells"))]
    watched = counted.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(whole).alias("rows_out"), *added)
    return watched.where(whole).select(*spec)


def coerce_scraped(df: DataFrame, schema: T.StructType, symbols: list[str] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Scraped strings to declared types, without rows that are null throughout; by symbol and first date column."""
    out = df.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema)).dropna(how="all")
    if symbols and "symbol" in out.columns:
        out = out.where(F.col("symbol").isin(symbols))
    date = next((f.name for f in schema if isinstance(f.dataType, (T.DateType, T.TimestampType))), None)
    if date and start:
        out = out.where(F.col(date) >= start)
    return out.where(F.col(date) <= end) if date and end else out


def futures_rows(df: DataFrame, root: str = "VX") -> DataFrame:
    """Rows of a futures CSV: `F (Jan 2024)` to a contract code, US dates, numbers coerced; rows lacking key fields go."""
    label = r"^\s*([FGHJKMNQUVXZ])\s*\((\w{3})\s+\d{2}(\d{2})\)"
    symbol = F.concat(F.lit(root), F.regexp_extract("Futures", label, 1), F.regexp_extract("Futures", label, 3))
    number = lambda c: F.regexp_replace(F.col(c), ",", "").try_cast("double")
    return df.select(
        F.try_to_timestamp(F.col("Trade Date"), F.lit("MM/dd/yyyy")).alias("timestamp"),
        F.when(F.col("Futures").rlike(label), symbol).alias("symbol"),
        *(number(c).alias(c.lower()) for c in ("Open", "High", "Low", "Settle")),
        number("Total Volume").cast("long").alias("volume"),
        number("Open Interest").cast("long").alias("open_interest"),
    ).dropna(subset=["timestamp", "symbol", "settle"])


FUTURES_HEADER = ("Trade Date", "Futures", "Open", "High", "Low", "Settle", "Total Volume", "Open Interest")


@dataclass(frozen=True)
class CsvFiles:
    """What was read: rows (the wanted columns as strings, and file), lines that do not fit their file's header (file, line), and files without the wanted columns (file, header, missing)."""

    rows: DataFrame
    malformed: DataFrame
    rejected: DataFrame


def read_csv_by_header(spark: SparkSession, path: str | list[str], wanted: Iterable[str], recursive: bool = False, strict: bool = True) -> CsvFiles:
    """CSV files with a header each, whose columns may stand in any order among others; names are compared without case and blanks around them.

    strict: a file that lacks a wanted column is an error that names it; else it is left out and reported. Files are read for
    their first lines, and then for their rows, those with one header together. Lines of too many or too few cells are
    no rows, nor are lines like the header. A cell does not go on over a line. An empty file has no header and no rows.
    """
    wanted = list(wanted)
    clean = lambda name: name.strip().lstrip("\ufeff").strip().lower()
    lines = spark.read.option("recursiveFileLookup", recursive).text(path)
    file = F.col("_metadata.file_path")
    first = lines.where("_metadata.file_block_start = 0").select("value", file.alias("file"), F.monotonically_increasing_id().alias("place"))
    first = first.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    # headers are few; files are listed by the driver in any case
    headers = [(r["header"], r["files"]) for r in first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()]
    rows = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in (*wanted, "file")))
    malformed, rejected = spark.createDataFrame([], "file string, line string"), []
    for header, files in sorted(headers, key=lambda h: h[1]):
        names = [clean(c) for c in next(csv.reader([header]), [])]
        missing = [c for c in wanted if names.count(clean(c)) != 1]
        if missing:
            rejected += [(f, header, ", ".join(missing)) for f in files]
            continue
        schema = ", ".join([*(f"c{k} string" for k in range(len(names))), "_line string"])
        cells = F.from_csv("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"})
        read = spark.read.text([unquote(f) for f in files]).where((F.col("value") != F.lit(header)) & (F.trim("value") != "")).select(file.alias("file"), "value", cells.alias("c"))
        rows = rows.unionByName(read.where("c._line IS NULL").select(*(F.trim(f"c.c{names.index(clean(c))}").alias(c) for c in wanted), "file"))
        malformed = malformed.unionByName(read.where("c._line IS NOT NULL").select("file", F.col("value").alias("line")))
    if strict and rejected:
        raise ValueError("; ".join(f"{f} lacks {missing}" for f, _, missing in rejected[:20]))
    return CsvFiles(rows, malformed, spark.createDataFrame(rejected, "file string, header string, missing string"))


def read_futures_csv(spark: SparkSession, path: str | list[str], root: str = "VX", strict: bool = True) -> DataFrame:
    """Bars of futures CSV files, by their headers; see read_csv_by_header() for files that lack a column."""
    return futures_rows(read_csv_by_header(spark, path, FUTURES_HEADER, strict=strict).rows, root)


CONTRACT_HEADER = ("date", "open", "high", "low", "close", "volume")


def read_contract_dir(spark: SparkSession, path: str, pattern: str = r"([A-Z]+[FGHJKMNQUVXZ]\d{2})[^/]*$", recursive: bool = False, strict: bool = True) -> DataFrame:
    """A folder of CSV files, one or more for each contract, which the pattern finds in a file's path; rows without contract or close go."""
    rows = read_csv_by_header(spark, path, CONTRACT_HEADER, recursive, strict).rows
    named = rows.withColumn("symbol", F.nullif(F.regexp_extract(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))), pattern, 1), F.lit("")))
    number = lambda c: F.col(c).try_cast("double")
    return named.select(
        F.col("date").try_cast("timestamp").alias("timestamp"), "symbol", *(number(c).alias(c) for c in ("open", "high", "low", "close")), number("volume").cast("long").alias("volume")
    ).dropna(subset=["symbol", "close"])


#: Fields of account payloads by kind: name in the payload, column, and what it is. Numbers default to 0, texts to "".
ACCOUNT_FIELDS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "balances": (("CashBalance", "cash", "number"), ("Equity", "equity", "number"), ("TimeStamp", "timestamp", "time")),
    "positions": (
        ("Symbol", "symbol", "key"), ("Quantity", "quantity", "number"), ("AveragePrice", "average_price", "number"), ("MarketValue", "market_value", "number"),
        ("UnrealizedProfitLoss", "unrealized_pnl", "number"), ("TimeStamp", "timestamp", "time"),
    ),
    "orders": (
        ("OrderID", "order_id", "text"), ("Symbol", "symbol", "text"), ("Quantity", "quantity", "number"), ("OrderType", "order_type", "text"), ("Side", "side", "text"), ("Status", "status", "text"),
        ("LimitPrice", "limit_price", "number"), ("StopPrice", "stop_price", "number"), ("FilledQuantity", "filled_quantity", "number"), ("RemainingQuantity", "remaining_quantity", "number"),
        ("AverageFillPrice", "average_fill_price", "number"), ("Duration", "duration", "text"), ("Route", "route", "text"), ("ExecutionTime", "execution_time", "time"),
        ("CancellationTime", "cancellation_time", "time"), ("Time", "timestamp", "time"),
    ),
    "trades": (
        ("OrderID", "order_id", "text"), ("TradeID", "trade_id", "text"), ("Symbol", "symbol", "text"), ("Quantity", "quantity", "number"), ("Price", "price", "number"), ("Side", "side", "text"),
        ("Commission", "commission", "number"), ("Fees", "fees", "number"), ("TradeTime", "trade_time", "time"), ("PositionEffect", "position_effect", "text"),
    ),
}


def normalise_account(df: DataFrame, kind: str, json: str = "payload") -> DataFrame:
    """Account payloads (balances, positions, orders, trades) to typed rows; times that do not parse are null, rows without an account go."""
    fields = ACCOUNT_FIELDS[kind]
    schema = ", ".join(f"{name} string" for name in dict.fromkeys(("AccountID", *(f[0] for f in fields))))
    read = {
        "number": lambda c: F.coalesce(c.try_cast("double"), F.lit(0.0)),
        "text": lambda c: F.coalesce(c, F.lit("")),
        "time": lambda c: F.regexp_replace(c, "Z$", "").try_cast("timestamp"),
        "key": lambda c: c,
    }
    x = df.select(F.from_json(json, schema).alias("x")).select("x.*").where("AccountID IS NOT NULL")
    key = [F.concat_ws("_", "AccountID", "Symbol").alias("position_id")] if kind == "positions" else []
    return x.select(*key, F.col("AccountID").alias("account_id"), *(read[what](F.col(name)).alias(column) for name, column, what in fields))


def build_metadata(config: DataFrame) -> DataFrame:
    """One row for each symbol and frequency of a configuration (symbols, frequencies: arrays); the first source of a pair wins."""
    each = config.select("source", "priority", F.explode("symbols").alias("symbol"), "frequencies").select("source", "priority", "symbol", F.explode("frequencies").alias("frequency"))
    text = F.col("frequency")
    unit = F.when(text.rlike("(?i)min"), "minute").when(text.rlike("(?i)h"), "hour").otherwise("daily")
    value = F.coalesce(F.nullif(F.regexp_extract(text, r"^(\d+)", 1), F.lit("")).try_cast("int"), F.lit(1))
    named = each.withColumns({"interval_unit": unit, "interval_value": value})
    rank = F.row_number().over(Window.partitionBy("symbol", "interval_unit", "interval_value").orderBy("priority", "source"))
    return named.withColumn("_rank", rank).where("_rank = 1").select("symbol", "interval_unit", "interval_value", "source")
