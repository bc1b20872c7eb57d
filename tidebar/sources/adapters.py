"""The market-data model over the given tables, in DataFrames and in the same SQL.

Each relation is defined twice: as a property of Tables and as a common table
expression of CTES, under one name. Prices are extended price over quantity;
ties of time are broken by the whole key of a line, so that first and last are
well defined.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Futures month codes, January to December.
MONTH_CODES = "FGHJKMNQUVXZ"
#: The order of the lines of a symbol and day: order, line, part, supplier as one number of 37 digits, made of two longs. A
#: decimal fits the rows of a hash aggregate, while ordering by a struct would make Spark sort all lines before it.
PLACE = (
    "cast((l_orderkey * 10 + l_linenumber) * 1000 + l_partkey div 100000000 as decimal(19, 0)) * cast(1000000000000000000 as decimal(19, 0))"
    " + cast(l_partkey % 100000000 * 10000000000 + l_suppkey as decimal(19, 0))"
)


class Tables:
    """The relations over the tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def fills(self) -> DataFrame:
        return (
            self.table("lineitem")
            .join(self.table("part").select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("p_brand").alias("symbol"),
                F.col("p_type").alias("root"),
                F.col("l_shipdate").cast("timestamp").alias("ts"),
                F.col("l_linenumber").alias("n"),
                (F.col("l_extendedprice") / F.col("l_quantity")).alias("px"),
                F.col("l_quantity").alias("q"),
                "l_linestatus",
                "l_returnflag",
                F.expr(PLACE).alias("k"),
            )
        )

    @cached_property
    def bars(self) -> DataFrame:
        of = lambda status: F.sum(F.when(F.col("l_linestatus") == status, F.col("q")).otherwise(0.0)).cast("long")
        return (
            self.fills.groupBy("symbol", F.col("ts").alias("timestamp"))
            .agg(
                *ohlc(F.col("px"), F.col("k")),
                F.sum("q").cast("long").alias("volume"),
                of("O").alias("up_volume"),
                of("F").alias("down_volume"),
                F.char(F.max(F.ascii("l_returnflag"))).alias("source"),  # one letter; as a number it fits a hash aggregate
            )
            .withColumns(
                {
                    "interval_value": F.lit(1),
                    "interval_unit": F.lit("daily"),
                    "quality": F.when(F.dayofyear("timestamp") % 11 == 0, 80).otherwise(100),
                }
            )
        )

    @cached_property
    def ticks(self) -> DataFrame:
        return self._events(F.col("event_type"))

    @cached_property
    def user_ticks(self) -> DataFrame:
        return self._events(F.concat(F.lit("U"), F.col("user_id").cast("string")))

    def _events(self, symbol: Column) -> DataFrame:
        value = F.col("value")
        return self.table("events").select(
            symbol.alias("symbol"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            *(value.alias(c) for c in ("open", "high", "low", "close")),
            F.lit(1).cast("long").alias("volume"),
            F.col("event_id").alias("id"),
            F.col("props").alias("params"),
        )

    @cached_property
    def tick_contracts(self) -> DataFrame:
        """Five contracts of each kind of event, which end six days after one another; each rolls two days before its end."""
        k = F.explode(F.sequence(F.lit(0), F.lit(4)))
        each = self.table("events").select(F.col("event_type").alias("root")).distinct().select("root", k.alias("k"))
        month = F.add_months(F.lit("2024-01-01").cast("date"), F.col("k"))
        last = F.date_add(F.lit("2024-01-06").cast("date"), F.col("k") * 6)
        return each.select("root", F.concat("root", F.expr(f"substr('{MONTH_CODES}', k + 1, 1)"), F.lit("24")).alias("symbol"), month.alias("expiry_month"), last.alias("last_date"), F.date_sub(last, 2).alias("roll_date"))

    @cached_property
    def contract_ticks(self) -> DataFrame:
        """Five-minute bars of these contracts: a user's events are trades of the contract that the user holds, up to its last day."""
        k, order = (F.col("user_id") % 5).cast("int"), F.struct("ts", "event_id")
        ticks = self.table("events").select(F.col("event_type").alias("root"), F.concat("event_type", F.expr(f"substr('{MONTH_CODES}', cast(user_id % 5 as int) + 1, 1)"), F.lit("24")).alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value", k.alias("k"))
        alive = ticks.where(F.to_date("ts") <= F.date_add(F.lit("2024-01-06").cast("date"), F.col("k") * 6))
        return alive.groupBy("root", "symbol", F.window("ts", "5 minutes")["start"].alias("timestamp")).agg(
            F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.count("*").alias("volume")
        )

    @cached_property
    def contract_bars(self) -> DataFrame:
        expiry = F.add_months(F.trunc("ts", "month"), F.col("n") - 1)
        code = F.expr(f"substr('{MONTH_CODES}', month(expiry), 1)")
        by_contract = Window.partitionBy("symbol").orderBy("timestamp")
        return (
            self.fills.withColumn("expiry", expiry)
            .withColumn("symbol", F.concat("root", code, F.date_format("expiry", "yy")))
            .groupBy("root", "symbol", F.col("expiry").alias("expiry_month"), F.col("ts").alias("timestamp"))
            .agg(*ohlc(F.col("px"), F.col("k")), F.sum("q").cast("long").alias("volume"))
            .withColumn("open_interest", F.sum("volume").over(by_contract))
        )

    @cached_property
    def contracts(self) -> DataFrame:
        return contracts_of(self.contract_bars)

    @cached_property
    def dirty_bars(self) -> DataFrame:
        doy = F.dayofyear("timestamp")
        hit = lambda n: doy % n == 0
        return self.bars.withColumns(
            {
                "close": F.when(hit(13), 0.0).otherwise(F.col("close")),
                "high": F.when(hit(17), F.col("low")).when(hit(29), F.col("high") * 10).otherwise(F.col("high")),
                "low": F.when(hit(17), F.col("high")).otherwise(F.col("low")),
                "open": F.when(~hit(19), F.col("open")),
                "volume": F.when(hit(23), 0).otherwise(F.col("volume")).cast("long"),
            }
        )

    @cached_property
    def econ(self) -> DataFrame:
        return (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_name").alias("indicator"), F.date_trunc("month", F.col("o_orderdate").cast("timestamp")).alias("timestamp"))
            .agg(F.round(F.avg("o_totalprice"), 4).alias("value"))
            .withColumn("revision_number", F.lit(0))
        )

    @cached_property
    def econ_meta(self) -> DataFrame:
        return self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("indicator"), F.col("r_name").alias("category"))

    @cached_property
    def acct_orders(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "O", "Open").when(F.col("o_orderstatus") == "F", "Filled").otherwise("PartiallyFilled")
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("account_id"), status.alias("status"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").cast("timestamp").alias("timestamp")
        )

    @cached_property
    def balances(self) -> DataFrame:
        days = self.acct_orders.groupBy("account_id", F.col("timestamp")).agg(F.count("*").alias("n")).drop("n")
        return days.join(self.table("customer").select(F.col("c_custkey").alias("account_id"), F.col("c_acctbal").alias("cash")), "account_id")

    @cached_property
    def positions(self) -> DataFrame:
        lines = self.table("lineitem").join(self.table("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        signed = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
        return (
            lines.join(self.acct_orders, F.col("l_orderkey") == F.col("order_id"))
            .groupBy("account_id", F.col("p_brand").alias("symbol"), "timestamp")
            .agg(
                F.sum(signed).cast("long").alias("quantity"),
                F.sum(F.col("l_extendedprice").cast("decimal(18, 4)")).cast("double").alias("market_value"),  # exact, in whatever order lines come
                F.sum((F.col("l_extendedprice") * (F.col("l_discount") - F.col("l_tax"))).cast("decimal(18, 6)")).cast("double").alias("unrealized_pnl"),
            )
        )

    @cached_property
    def specs(self) -> DataFrame:
        """What a contract of each symbol is worth a point, and its margin."""
        return self.table("part").groupBy(F.col("p_brand").alias("symbol")).agg(F.max("p_retailprice").alias("margin")).withColumn("multiplier", F.regexp_extract("symbol", "([0-9]+)$", 1).cast("int") % 4 * 25.0 + 25.0)


def contracts_of(bars: DataFrame) -> DataFrame:
    """(root, symbol, expiry_month, first_date, last_date, days) of contracts' bars."""
    return bars.groupBy("root", "symbol", "expiry_month").agg(F.to_date(F.min("timestamp")).alias("first_date"), F.to_date(F.max("timestamp")).alias("last_date"), F.count("*").alias("days"))


def ohlc(px: Column, key: Column) -> list[Column]:
    """Open, high, low and close of a group, first and last by key."""
    return [F.min_by(px, key).alias("open"), F.max(px).alias("high"), F.min(px).alias("low"), F.max_by(px, key).alias("close")]


_OHLC = "arg_min(px, k) AS open, max(px) AS high, min(px) AS low, arg_max(px, k) AS close"
_EVENTS = "ts AS timestamp, value AS open, value AS high, value AS low, value AS close, CAST(1 AS BIGINT) AS volume, event_id AS id, props AS params FROM events"

#: The same relations for DuckDB; one may use those before it.
CTES: dict[str, str] = {
    "fills": "SELECT p_brand AS symbol, p_type AS root, l_shipdate AS ts, l_linenumber AS n, l_extendedprice / l_quantity AS px, l_quantity AS q, l_linestatus, l_returnflag, "
    "{'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey, 'd': l_suppkey, 'e': l_extendedprice, 'f': l_quantity} AS k FROM lineitem JOIN part ON l_partkey = p_partkey",
    "bars": f"SELECT symbol, ts AS timestamp, {_OHLC}, CAST(sum(q) AS BIGINT) AS volume, CAST(sum(CASE WHEN l_linestatus = 'O' THEN q ELSE 0 END) AS BIGINT) AS up_volume, "
    "CAST(sum(CASE WHEN l_linestatus = 'F' THEN q ELSE 0 END) AS BIGINT) AS down_volume, max(l_returnflag) AS source, 1 AS interval_value, 'daily' AS interval_unit, "
    "CASE WHEN dayofyear(ts) % 11 = 0 THEN 80 ELSE 100 END AS quality FROM fills GROUP BY symbol, ts",
    "ticks": f"SELECT event_type AS symbol, {_EVENTS}",
    "user_ticks": f"SELECT 'U' || user_id AS symbol, {_EVENTS}",
    "tick_contracts": f"SELECT root, root || substr('{MONTH_CODES}', CAST(k AS INT) + 1, 1) || '24' AS symbol, k, CAST(DATE '2024-01-01' + to_months(CAST(k AS INT)) AS DATE) AS expiry_month, DATE '2024-01-06' + CAST(k * 6 AS INT) AS last_date, DATE '2024-01-04' + CAST(k * 6 AS INT) AS roll_date FROM (SELECT DISTINCT event_type AS root FROM events), unnest(range(5)) AS u(k)",
    "contract_ticks": "SELECT k.root, k.symbol, time_bucket(INTERVAL 5 MINUTE, ts) AS timestamp, arg_min(value, {'a': ts, 'b': event_id}) AS open, max(value) AS high, min(value) AS low, arg_max(value, {'a': ts, 'b': event_id}) AS close, count(*) AS volume FROM events JOIN tick_contracts k ON k.root = event_type AND k.k = user_id % 5 AND CAST(ts AS DATE) <= last_date GROUP BY 1, 2, 3",
    "contract_fills": f"SELECT *, CAST(date_trunc('month', ts) + to_months(n - 1) AS DATE) AS expiry FROM fills",
    "contract_days": f"SELECT root, root || substr('{MONTH_CODES}', CAST(month(expiry) AS INT), 1) || strftime(expiry, '%y') AS symbol, expiry AS expiry_month, ts AS timestamp, {_OHLC}, CAST(sum(q) AS BIGINT) AS volume FROM contract_fills GROUP BY root, expiry, ts",
    "contract_bars": "SELECT *, CAST(sum(volume) OVER (PARTITION BY symbol ORDER BY timestamp) AS BIGINT) AS open_interest FROM contract_days",
    "contracts": "SELECT root, symbol, expiry_month, CAST(min(timestamp) AS DATE) AS first_date, CAST(max(timestamp) AS DATE) AS last_date, count(*) AS days FROM contract_bars GROUP BY root, symbol, expiry_month",
    "dirty_bars": "SELECT symbol, timestamp, CASE WHEN dayofyear(timestamp) % 19 <> 0 THEN open END AS open, CASE WHEN dayofyear(timestamp) % 17 = 0 THEN low WHEN dayofyear(timestamp) % 29 = 0 THEN high * 10 ELSE high END AS high, "
    "CASE WHEN dayofyear(timestamp) % 17 = 0 THEN high ELSE low END AS low, CASE WHEN dayofyear(timestamp) % 13 = 0 THEN 0.0 ELSE close END AS close, CAST(CASE WHEN dayofyear(timestamp) % 23 = 0 THEN 0 ELSE volume END AS BIGINT) AS volume, "
    "up_volume, down_volume, source, interval_value, interval_unit, quality FROM bars",
    "econ": "SELECT n_name AS indicator, date_trunc('month', o_orderdate) AS timestamp, round(avg(o_totalprice), 4) AS value, 0 AS revision_number FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL",
    "econ_meta": "SELECT n_name AS indicator, r_name AS category FROM nation JOIN region ON n_regionkey = r_regionkey",
    "acct_orders": "SELECT o_orderkey AS order_id, o_custkey AS account_id, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' ELSE 'PartiallyFilled' END AS status, o_totalprice AS amount, o_orderdate AS timestamp FROM orders",
    "specs": "SELECT p_brand AS symbol, max(p_retailprice) AS margin, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INT) % 4 * 25.0::DOUBLE + 25.0::DOUBLE AS multiplier FROM part GROUP BY p_brand",
    "balances": "SELECT DISTINCT account_id, timestamp, c_acctbal AS cash FROM acct_orders JOIN customer ON account_id = c_custkey",
    "positions": "SELECT account_id, p_brand AS symbol, timestamp, CAST(sum(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END) AS BIGINT) AS quantity, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 4))) AS DOUBLE) AS market_value, "
    "CAST(sum(CAST(l_extendedprice * (l_discount - l_tax) AS DECIMAL(18, 6))) AS DOUBLE) AS unrealized_pnl FROM lineitem JOIN part ON l_partkey = p_partkey JOIN acct_orders ON l_orderkey = order_id GROUP BY ALL",
}
