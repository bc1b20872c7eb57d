"""Tables in partitions: only touched files change, and a change that broke off is finished or dropped."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidebar.sources import partitions

SCHEMA = "symbol string, timestamp timestamp, close double"
MONTHS = partitions.by_month()


def rows(spark, *each):
    return spark.createDataFrame([(s, dt.datetime.fromisoformat(d), c) for s, d, c in each], SCHEMA)


def files(path):
    return {os.path.join(os.path.relpath(d, path), f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet") and partitions.PENDING not in d}


def month(names, m):
    return {n for n in names if n.startswith(f"month={m}")}


def state(spark, path):
    return sorted((r["symbol"], r["timestamp"].date().isoformat(), r["close"]) for r in partitions.read(spark, path, MONTHS).collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "bars")
    partitions.create(rows(spark, ("A", "2024-01-03", 1.0), ("A", "2024-02-05", 2.0), ("B", "2024-02-06", 3.0), ("A", "2024-03-04", 4.0)), path, MONTHS)
    return path


def test_upsert_touches_the_partitions_of_its_rows_alone(spark, table):
    before = files(table)
    change = rows(spark, ("A", "2024-02-05", 20.0), ("C", "2024-04-01", 5.0), ("C", "2024-04-01", 5.0))
    partitions.upsert_table(change, table, ["symbol", "timestamp"], MONTHS)
    after = files(table)
    assert month(before, "2024-01") == month(after, "2024-01") and month(before, "2024-03") == month(after, "2024-03")
    assert not month(before, "2024-02") & month(after, "2024-02") and month(after, "2024-04")
    want = [("A", "2024-01-03", 1.0), ("A", "2024-02-05", 20.0), ("A", "2024-03-04", 4.0), ("B", "2024-02-06", 3.0), ("C", "2024-04-01", 5.0)]
    assert state(spark, table) == want
    partitions.upsert_table(change, table, ["symbol", "timestamp"], MONTHS)  # once more: the same
    assert state(spark, table) == want and not os.path.exists(f"{table}/{partitions.PENDING}")


def test_upsert_reads_the_partitions_of_its_rows_alone(spark, table):
    stored = partitions._stored(spark, table, rows(spark), MONTHS).where(partitions._among(["month"], [("2024-02",)]))
    assert stored.select("_folder").distinct().count() == 1
    assert "= 2024-02)], PushedFilters: []" in stored._jdf.queryExecution().toString()  # a filter on the partition, none on files


def test_update_of_some_columns_and_first_rows(spark, tmp_path):
    path = str(tmp_path / "new")
    partitions.upsert_table(rows(spark, ("A", "2024-01-03", 1.0), (None, "2024-01-04", 2.0)), path, ["symbol", "timestamp"], MONTHS)
    assert partitions.read(spark, path, MONTHS).count() == 2
    partitions.upsert_table(rows(spark, ("A", "2024-01-03", 9.0), ("B", "2024-01-03", 3.0)), path, ["symbol", "timestamp"], MONTHS, update=[])
    got = {(r["symbol"], r["close"]) for r in partitions.read(spark, path, MONTHS).collect()}
    assert got == {("A", 1.0), (None, 2.0), ("B", 3.0)}
    partitions.upsert_table(rows(spark), path, ["symbol", "timestamp"], MONTHS)
    assert partitions.read(spark, path, MONTHS).count() == 3


def test_replaced_range_empties_and_keeps_partitions(spark, table):
    before = files(table)
    partitions.replace_range_table(rows(spark, ("A", "2024-02-20", 7.0)), table, "2024-02-01", "2024-03-31", MONTHS, F.col("symbol") == "A")
    after = files(table)
    assert month(before, "2024-01") == month(after, "2024-01") and not month(after, "2024-03") and not os.path.exists(f"{table}/month=2024-03")
    assert state(spark, table) == [("A", "2024-01-03", 1.0), ("A", "2024-02-20", 7.0), ("B", "2024-02-06", 3.0)]
    with pytest.raises(ValueError):
        partitions.replace_range_table(rows(spark, ("A", "2025-01-01", 7.0)), table, "2024-02-01", "2024-03-31", MONTHS)
    partitions.replace_range_table(rows(spark), table, "2024-01-01", "2024-12-31", MONTHS)  # nothing is left
    assert files(table) == set()
    partitions.upsert_table(rows(spark, ("A", "2024-05-01", 1.0)), table, ["symbol", "timestamp"], MONTHS)
    assert state(spark, table) == [("A", "2024-05-01", 1.0)]


def test_a_change_that_broke_off(spark, table, monkeypatch):
    change, keys = rows(spark, ("A", "2024-02-05", 20.0)), ["symbol", "timestamp"]
    was = state(spark, table)
    with monkeypatch.context() as m:  # before it was ready
        m.setattr(partitions, "READY", "nowhere/_ready")
        m.setattr(partitions, "settle", lambda spark, path: None)
        partitions.upsert_table(change, table, keys, MONTHS)
    assert os.path.exists(f"{table}/{partitions.PENDING}") and state(spark, table) == was and not os.path.exists(f"{table}/{partitions.PENDING}")
    with monkeypatch.context() as m:  # after: the next reader or writer finishes it, even if a partition is gone by then
        m.setattr(partitions, "settle", lambda spark, path: None)
        partitions.upsert_table(change, table, keys, MONTHS)
    partitions._delete(spark, f"{table}/month=2024-02")
    assert state(spark, table) == [("A", "2024-01-03", 1.0), ("A", "2024-02-05", 20.0), ("A", "2024-03-04", 4.0), ("B", "2024-02-06", 3.0)]
