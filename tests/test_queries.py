"""Every query against its SQL in DuckDB at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__
from tidebar.plans import catalog

SMALL = "/root/testdata/sf0.001"
KEYS = sorted(catalog.SQL)


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        out.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return out


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return (0, "")
    if isinstance(value, bool) or isinstance(value, str):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, f"{value:.3f}".replace("-0.000", "0.000"))
    return (3, str(value))


def near(a, b):
    if a is None or b is None or isinstance(a, (str, bool)) or not isinstance(a, (int, float)):
        return plain(a) == plain(b)
    return plain(a) == plain(b) or abs(a - b) <= 1e-5 * max(1, abs(a))


@pytest.mark.parametrize("key", KEYS)
def test_rows_equal_sql(spark, con, key):
    df = catalog.QUERIES[key](spark, SMALL)
    result = con.execute(catalog.SQL[key])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=lambda r: tuple(map(plain, r)))
    want = sorted(result.fetchall(), key=lambda r: tuple(map(plain, r)))
    assert len(got) == len(want)
    assert all(near(a, b) for x, y in zip(got, want) for a, b in zip(x, y))


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
