"""CSV files by their headers, and metrics of cleaning from the job that cleans."""

import pytest
from pyspark.sql import Observation

from tidebar.sources import tables

HEADER = ",".join(tables.FUTURES_HEADER)


def write(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def test_columns_are_taken_by_name(spark, tmp_path):
    write(tmp_path, "a.csv", HEADER, "01/02/2024,F (Jan 2024),15,20,10,12.5,\"1,000\",7")
    write(tmp_path, "b.csv", "﻿Trade Date, High ,LOW,Open,Futures,Settle,Open Interest,Total Volume,Change", "01/03/2024,20,10,15,G (Feb 2024),12,8,1000,0.5", "01/04/2024,20,10,15,G (Feb 2024),13,8,1000,0.5")
    (tmp_path / "empty.csv").write_text("")
    got = sorted((r["timestamp"].day, r["symbol"], r["open"], r["high"], r["low"], r["settle"], r["volume"], r["open_interest"]) for r in tables.read_futures_csv(spark, str(tmp_path)).collect())
    assert got == [(2, "VXF24", 15.0, 20.0, 10.0, 12.5, 1000, 7), (3, "VXG24", 15.0, 20.0, 10.0, 12.0, 1000, 8), (4, "VXG24", 15.0, 20.0, 10.0, 13.0, 1000, 8)]


def test_files_that_lack_a_column_are_named(spark, tmp_path):
    write(tmp_path, "good.csv", HEADER, "01/02/2024,F (Jan 2024),15,20,10,12.5,1000,7")
    write(tmp_path, "bad.csv", HEADER.replace("Settle", "Close"), "01/02/2024,F (Jan 2024),15,20,10,12.5,1000,7")
    write(tmp_path, "twice.csv", HEADER.replace("Low", "High"), "01/02/2024,F (Jan 2024),15,20,10,12.5,1000,7")
    with pytest.raises(ValueError, match="bad.csv lacks Settle"):
        tables.read_futures_csv(spark, str(tmp_path))
    found = tables.read_csv_by_header(spark, str(tmp_path), tables.FUTURES_HEADER, strict=False)
    assert sorted((r["file"].rsplit("/")[-1], r["missing"]) for r in found.rejected.collect()) == [("bad.csv", "Settle"), ("twice.csv", "High, Low")]
    assert found.rows.count() == 1 and tables.read_futures_csv(spark, str(tmp_path), strict=False).count() == 1


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    write(tmp_path, "a.csv", "date,open,high,low,close,volume", "2024-01-02,1,2,0.5,1.5,10", "2024-01-03,1,2", "2024-01-04,1,2,0.5,1.5,10,11,12", "2024-01-05,1,2,0.5,,10")
    found = tables.read_csv_by_header(spark, str(tmp_path), tables.CONTRACT_HEADER)
    assert found.rows.count() == 2 and sorted(r["line"] for r in found.malformed.collect()) == ["2024-01-03,1,2", "2024-01-04,1,2,0.5,1.5,10,11,12"]


def test_contracts_by_file_and_folder_name(spark, tmp_path):
    line = ("date,open,high,low,close,volume", "2024-01-02,1,2,0.5,1.5,10")
    write(tmp_path, "VXF24 daily.csv", *line)
    write(tmp_path, "notes.csv", *line)
    write(tmp_path / "deep", "ESH24.csv", *line)
    assert [r["symbol"] for r in tables.read_contract_dir(spark, str(tmp_path)).collect()] == ["VXF24"]
    assert sorted(r["symbol"] for r in tables.read_contract_dir(spark, str(tmp_path), recursive=True).collect()) == ["ESH24", "VXF24"]


def test_metrics_come_with_the_rows(spark):
    rows = [("1", "5", "a"), ("x", "50", "b"), ("3", "500", None), ("4", "oops", "c")]
    spec = {"id": {"type": "int", "required": True}, "price": {"type": "double", "min": 10.0, "max": 100.0}, "kind": {"allowed": ["a", "b"], "default": "other"}}
    df = spark.createDataFrame(rows, "id string, px string, kind string")
    seen = Observation("test")
    got = tables.normalise(df, spec, {"px": "price"}, seen).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, tables.normalise(df, spec, {"px": "price"}).collect())) and len(got) == 3
    assert seen.get == {"rows_in": 4, "rows_out": 3, "missing_filled": 2, "outliers_corrected": 2, "invalid_cells": 3}
    bars = spark.createDataFrame([("A1", "x"), ("B1", "x"), ("A2", "new"), (None, "x")], "symbol string, source string")
    seen = Observation("retag")
    assert sorted(r["source"] for r in tables.retag_source(bars, "^A", "new", seen).collect()) == ["new", "new", "x", "x"]
    assert seen.get == {"rows": 4, "changed": 1}
