"""The state of a stream: one manifest, batches that are run again, and folders that go."""

import os

from tidebar.streaming import streams

SCHEMA = "symbol string, day int, close double"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def state(spark, path):
    return sorted(map(tuple, streams.latest_state(spark, path).select("symbol", "day", "close").collect()))


def folders(path):
    return {f"{v}/{b}" for v in os.listdir(path) if v.startswith("_version=") for b in os.listdir(f"{path}/{v}") if b.startswith("_bucket=")}


def test_batches_and_their_second_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "BUCKETS", 4)
    path, keys, want = str(tmp_path / "state"), ["symbol", "day"], {}
    for n in range(12):
        rows = [(s, n % 5, float(n)) for s in "ABCD"[: 1 + n % 4]]
        want |= {r[:2]: r[2] for r in rows}
        for _ in range(1 + n % 2):  # every second batch is run again
            streams.upsert_batch(batch(spark, *rows), n, keys, path)
        assert state(spark, path) == sorted((*k, v) for k, v in want.items())
    assert streams._manifest(spark, path)["version"] == 11
    assert len(folders(path)) <= 2 * 4 and len([v for v in os.listdir(path) if v.startswith("_version=")]) <= 2 * 4
    assert [f for f in os.listdir(path) if f.startswith(streams.MANIFEST)] == [streams.MANIFEST]


def test_a_batch_that_broke_off_before_its_manifest(spark, tmp_path, monkeypatch):
    path, keys = str(tmp_path / "state"), ["symbol", "day"]
    streams.upsert_batch(batch(spark, ("A", 1, 1.0), ("B", 1, 1.0)), 0, keys, path)
    with monkeypatch.context() as m:
        m.setattr(streams, "_put_manifest", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        try:
            streams.upsert_batch(batch(spark, ("A", 1, 2.0)), 1, keys, path)
        except OSError:
            pass
    assert state(spark, path) == [("A", 1, 1.0), ("B", 1, 1.0)]
    streams.upsert_batch(batch(spark, ("A", 1, 2.0)), 1, keys, path)
    assert state(spark, path) == [("A", 1, 2.0), ("B", 1, 1.0)]
    streams.upsert_batch(batch(spark), 2, keys, path)  # nothing comes: nothing is written
    assert state(spark, path) == [("A", 1, 2.0), ("B", 1, 1.0)]


def test_a_batch_lists_no_folder(spark, tmp_path, monkeypatch):
    """What it looks up is the manifest and the folders of the buckets that it touches."""
    path = str(tmp_path / "state")
    for n in range(3):
        streams.upsert_batch(batch(spark, ("A", n, 1.0)), n, ["symbol", "day"], path)
    for n in range(500):  # versions that nobody names cost nothing
        os.makedirs(f"{path}/_version={1000 + n}/_bucket=1")
    streams.upsert_batch(batch(spark, ("A", 3, 1.0)), 3, ["symbol", "day"], path)
    assert len(state(spark, path)) == 4 and not hasattr(streams, "_folders")
