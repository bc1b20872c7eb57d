"""Changes of a Parquet table that lies in partitions: only those that a change touches are read and written.

A partition is given by expressions on a row's key, such as the month of its timestamp, so that a key never moves.
A change has two steps. First the new rows of the partitions that it touches are written beside the table,
under PENDING, which readers pass over, with a list of these partitions. When that is whole (READY stands there), they take the place of
the old ones by dynamic partition overwrite, partitions that have no rows left are removed, and PENDING goes.

A change that broke off in the first step has changed nothing. One that broke off in the second is finished by the next
change (or by settle()), from what is pending. A change that is made twice gives the same table. One change at a time:
a second writer is not kept out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebar.sources.tables import upsert

PENDING = "_pending"
READY = "_ready"


def by_month(column: str = "timestamp") -> dict[str, str]:
    """A partition for each month of a column, as an expression in SQL by its name."""
    return {"month": f"date_format({column}, 'yyyy-MM')"}


def _placed(df: DataFrame, by: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(text).cast("string") for name, text in by.items()})


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path as that knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    fs, place = _place(spark, path)
    return bool(fs.exists(place))


def _delete(spark: SparkSession, path: str) -> None:
    fs, place = _place(spark, path)
    fs.delete(place, True)


def _has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written under path."""
    fs, place = _place(spark, path)
    return bool(fs.exists(place)) and any(not str(f.getPath().getName()).startswith(("_", ".")) for f in fs.listStatus(place))


def _stored(spark: SparkSession, path: str, like: DataFrame, by: Mapping[str, str]) -> DataFrame:
    """The table's rows with their partitions and the folder of each; partition values are read as they were written, as strings."""
    schema = like.select(*[c for c in like.columns if c not in by]).schema
    for name in by:
        schema = schema.add(name, "string")
    return spark.read.schema(schema).parquet(path).withColumn("_folder", F.regexp_replace("_metadata.file_path", "/[^/]*$", ""))


def create(df: DataFrame, path: str, by: Mapping[str, str]) -> None:
    """Write a table anew, in partitions."""
    _placed(df, by).write.mode("overwrite").partitionBy(*by).parquet(path)


def read(spark: SparkSession, path: str, by: Mapping[str, str] | None = None) -> DataFrame:
    """The table without its partition columns, after finishing what is pending."""
    settle(spark, path)
    return spark.read.parquet(path).drop(*(by or {}))


def settle(spark: SparkSession, path: str) -> None:
    """Finish a change that broke off, or drop it if its rows are not whole."""
    pending = f"{path}/{PENDING}"
    if not _exists(spark, pending):
        return
    if _exists(spark, f"{pending}/{READY}"):
        touched = spark.read.parquet(f"{pending}/touched")
        names = [c for c in touched.columns if c != "_folder"]
        if _has_rows(spark, f"{pending}/rows"):
            schema = spark.read.parquet(f"{pending}/rows").drop(*names).schema
            for name in names:
                schema = schema.add(name, "string")
            rows = spark.read.schema(schema).parquet(f"{pending}/rows")
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*names).parquet(path)
        # a row for each partition that the change leaves empty
        for r in touched.where("_folder IS NOT NULL").collect():
            _delete(spark, r["_folder"])
    _delete(spark, pending)


def _change(rows: DataFrame, stored: DataFrame | None, path: str, by: Mapping[str, str]) -> None:
    """Put rows, all that the touched partitions are to hold, in place of what stored has of these."""
    spark, names, pending = rows.sparkSession, list(by), f"{path}/{PENDING}"
    _delete(spark, pending)
    rows.write.partitionBy(*names).parquet(f"{pending}/rows")
    emptied = spark.createDataFrame([], ", ".join(f"{c} string" for c in (*names, "_folder")))
    if stored is not None:
        kept = spark.read.schema(", ".join(f"`{c}` string" for c in names)).parquet(f"{pending}/rows") if _has_rows(spark, f"{pending}/rows") else emptied
        gone = stored.select(*names, "_folder").distinct().join(kept.select(*names).distinct(), names, "left_anti")
        emptied = emptied.unionByName(gone)
    emptied.write.parquet(f"{pending}/touched")
    fs, place = _place(spark, f"{pending}/{READY}")
    fs.create(place).close()
    settle(spark, path)


def upsert_table(incoming: DataFrame, path: str, keys: list[str], by: Mapping[str, str], update: list[str] | None = None) -> None:
    """upsert() into the table at path, or its first rows; see there for keys that repeat and columns of update.

    The partitions of the incoming rows, a value each, are known to the driver, so that only their files are listed and read.
    """
    spark = incoming.sparkSession
    settle(spark, path)
    fresh = _placed(incoming, by)
    stored = None
    if _has_rows(spark, path):
        touched = [tuple(r) for r in fresh.select(*by).distinct().collect()]
        stored = _stored(spark, path, incoming, by).where(_among(list(by), touched))
        fresh = _placed(upsert(stored.drop(*by, "_folder"), incoming, keys, update), by)
    else:
        fresh = _placed(upsert(incoming.limit(0), incoming, keys), by)
    _change(fresh, stored, path, by)


def _among(names: list[str], values: list[tuple]) -> Column:
    """A condition on partition columns alone, which prunes partitions before any file is read."""
    if len(names) == 1:
        known, null = [v[0] for v in values if v[0] is not None], any(v[0] is None for v in values)
        return F.col(names[0]).isin(known) | (F.col(names[0]).isNull() & F.lit(null))
    out = F.lit(False)
    for value in values:
        one = F.lit(True)
        for name, v in zip(names, value):
            one = one & F.col(name).eqNullSafe(F.lit(v))
        out = out | one
    return out


def replace_range_table(incoming: DataFrame, path: str, start: str, end: str, by: Mapping[str, str], condition: Column | None = None, column: str = "timestamp") -> None:
    """Rows of the table from start to end (inclusive) that meet the condition give way to the incoming ones.

    by: one partition that grows with `column`, such as by_month(). Partitions outside the range are neither read nor
    written. Incoming rows outside it are an error, as they would stand beside what is there.
    """
    if len(by) != 1:
        raise ValueError("a range is replaced in a table with one partition column")
    spark, (name,) = incoming.sparkSession, by
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    inside = F.col(column).between(low, high) & (F.coalesce(condition, F.lit(False)) if condition is not None else F.lit(True))
    outside = incoming.where(~F.coalesce(inside, F.lit(False)))
    if not outside.isEmpty():
        raise ValueError("incoming rows outside the range that they replace")
    settle(spark, path)
    fresh, stored = _placed(incoming, by), None
    if _has_rows(spark, path):
        ends = [_placed(spark.range(1).select(x.alias(column)), by).first()[name] for x in (low, high)]
        stored = _stored(spark, path, incoming, by).where(F.col(name).between(*ends))
        kept = stored.where(~F.coalesce(inside, F.lit(False))).drop("_folder")
        fresh = kept.unionByName(fresh.select(*kept.columns))
    _change(fresh, stored, path, by)
