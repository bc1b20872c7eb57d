"""All pairs of symbols by date, in blocks: the sums of a Gram matrix without a join of each date with itself.

Symbols are dealt into blocks of some BLOCK, dates into chunks of CHUNK days. The rows of a block and date are packed
into one array; for every two blocks and each chunk these meet in one task, which lays out their pairs date by
date. Sums by pair of symbols then find all dates of a chunk in one task and leave it as one row a pair and chunk, where
a join by date would hand on one row a pair and date. Rows move once to be packed and once for each block.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebar.functions.scalars import day

#: Symbols of a block, about, and days of a chunk.
BLOCK, CHUNK = 128, 1024


def pairs_by_date(rows: DataFrame, value: str, same: bool = False, date: str = "timestamp", block: int | None = None, chunk: int | None = None) -> DataFrame:
    """(symbol, other, x, y): a row for each two symbols (symbol < other, and equal if same) and each time at which both have a row.

    rows: symbol, date and value, one row for each symbol and time. Only aggregates by symbol and other should follow: these
    rows are laid out within tasks. A time (not only its date) has to be the same; null symbols and times meet nothing.
    """
    block, chunk = block or BLOCK, chunk or CHUNK
    symbols = rows.agg(F.approx_count_distinct("symbol").alias("n")).first()["n"]
    blocks = max(1, math.ceil(symbols / block))
    own = F.pmod(F.xxhash64("symbol"), F.lit(blocks)).cast("int")
    known = rows.where(F.col("symbol").isNotNull() & F.col(date).isNotNull())
    part = F.floor(F.unix_date(day(date)) / chunk)
    packed = known.select(own.alias("block"), part.alias("chunk"), F.col(date).alias("time"), F.struct("symbol", F.col(value).alias("v")).alias("row"))
    packed = packed.groupBy("chunk", "block", "time").agg(F.collect_list("row").alias("rows"))  # a row for each symbol of a block
    role = lambda a, b, left: F.struct(a.alias("a"), b.alias("b"), F.lit(left).alias("is_left"))
    # as the left of its own and all later blocks, as the right of its own and all earlier ones
    roles = F.concat(F.transform(F.sequence("block", F.lit(blocks - 1)), lambda b: role(F.col("block"), b, True)), F.transform(F.sequence(F.lit(0), F.col("block")), lambda a: role(a, F.col("block"), False)))
    dealt = packed.select("chunk", "time", "rows", F.inline(roles)).repartition("a", "b", "chunk")
    # all dates of two blocks and a chunk are in one task now; the sides of a date find each other there
    of = lambda c: F.any_value(F.when(c, F.col("rows")), F.lit(True))
    cells = dealt.groupBy("a", "b", "chunk", "time").agg(of(F.col("is_left")).alias("left"), of(~F.col("is_left")).alias("right"))
    each = cells.where("left IS NOT NULL AND right IS NOT NULL").select("a", "b", F.explode("left").alias("l"), "right").select("a", "b", "l", F.explode("right").alias("r"))
    laid = each.select("a", "b", F.col("l.symbol").alias("s"), F.col("r.symbol").alias("o"), F.col("l.v").alias("p"), F.col("r.v").alias("q"))
    # two symbols of one block meet both ways round, of different blocks once: the lesser name comes first
    within = F.col("a") == F.col("b")
    fits = F.when(within, F.col("s") <= F.col("o") if same else F.col("s") < F.col("o")).otherwise(F.lit(True))
    turned = ~within & (F.col("s") > F.col("o"))
    pick = lambda x, y: F.when(turned, F.col(y)).otherwise(F.col(x))
    return laid.where(fits).select(pick("s", "o").alias("symbol"), pick("o", "s").alias("other"), pick("p", "q").alias("x"), pick("q", "p").alias("y"))
