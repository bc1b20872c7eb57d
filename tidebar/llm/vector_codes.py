"""Vector code compression: a codebook for each part of the vectors, fitted over blocks along a Hilbert curve.

Components become whole numbers, floor(SCALE * x), and vectors are cut into PARTS equal parts. The different
values of a part, each with how often it stands, are sorted along a Hilbert curve and written
as flat blocks of up to BLOCK values, with the box (least and greatest components) and the sum of each.
A round reads the blocks: from the distances between a block's box and the codebook's entries comes the
block's shortlist, the entries that can be nearest to anything in the box. A block with a
shortlist of one goes to it by its sum alone; of others each value is compared with the shortlist
by a small kernel in whole numbers. Only sums by entry come to the driver (PARTS * ENTRIES rows at most), which makes the
next codebook of them; an entry that nothing is nearest to stays. The codes are then given to the
vectors where they stand, by the same blocks and shortlists within each batch.

The curve decides what a round costs, never what it returns. Its cells are set by the entries that
the codebooks start with.

Vectors that are null, or hold null or non-finite components, are dropped. Vectors of unequal length count
as if the shorter ended in zeros, up to the next multiple of PARTS; empty ones have nothing but zeros. Components
are held within +-LARGEST, errors within a long. Of equally near entries the lower index counts; repeated rows are rows like
any other. A codebook starts with the vectors of the least ids (of equal ids, the lesser components first; a null id is
beyond all others, but its row gets a code like any other), fewer than ENTRIES if there are fewer. Null labels count as one label.
No rows give none; columns of any other name play no part.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebar.session import shared_folder

from .common import cut, join_hot, removed

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Values in a block.
BLOCK = 64
#: Components are held within these ends, so that they are exact in a double.
LARGEST = 2**53
#: Blocks whose boxes are compared with a codebook at once.
BOXES = 128
_LONG = np.iinfo(np.int64)


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """id, label and q, an array of longs that holds floor(scale * x), of the vectors that take part."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = lambda x: F.floor(F.greatest(F.least(x, F.lit(float(LARGEST))), F.lit(-float(LARGEST))))
    return (
        vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.transform(F.col(embedding), lambda x: x.cast("double")).alias("v"))
        .where(F.col("v").isNotNull() & fine)
        .select("id", "label", F.transform("v", lambda x: held(x * float(scale))).alias("q"))
    )


def matrix(rows: pd.Series, width: int) -> np.ndarray:
    """The rows as longs, each filled up with zeros."""
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


# the curve ----------------------------------------------------------------------------------------------------------


class Curve:
    """Places along a Hilbert curve for the values of one part; cells are cut at quantiles of the given sample."""

    def __init__(self, sample: np.ndarray):
        self.dims = min(sample.shape[1], 64)  # further components have no part in the order
        self.bits = max(1, min(8, 64 // max(1, self.dims)))
        edges = np.linspace(0, 1, (1 << self.bits) + 1)[1:-1]
        self.edges = np.quantile(sample[:, : self.dims], edges, axis=0) if len(sample) and self.dims else np.zeros((len(edges), self.dims))

    def places(self, values: np.ndarray) -> np.ndarray:
        """A long for each row, in the order of the curve."""
        cells = np.array([np.searchsorted(self.edges[:, d], values[:, d], side="right") for d in range(self.dims)], dtype=np.uint64).reshape(self.dims, len(values))
        # axes to the transposed Hilbert index: undo excess work from the top bit down, then Gray encode
        one = np.uint64(1)
        for b in range(self.bits - 1, 0, -1):
            q = one << np.uint64(b)
            low = q - one
            for d in range(self.dims):
                set_ = (cells[d] & q) != 0
                swap = np.where(set_, np.uint64(0), (cells[0] ^ cells[d]) & low)
                cells[0] = np.where(set_, cells[0] ^ low, cells[0] ^ swap)
                cells[d] ^= swap
        for d in range(1, self.dims):
            cells[d] ^= cells[d - 1]
        turn = np.zeros(len(values), np.uint64)
        for b in range(self.bits - 1, 0, -1):
            turn ^= np.where((cells[-1] >> np.uint64(b)) & one, (one << np.uint64(b)) - one, np.uint64(0)) if self.dims else turn
        out = np.zeros(len(values), np.uint64)
        for b in range(self.bits - 1, -1, -1):
            for d in range(self.dims):
                out = (out << one) | (((cells[d] ^ turn) >> np.uint64(b)) & one)
        return (out ^ (one << np.uint64(63))).view(np.int64)


# shortlists and kernels -----------------------------------------------------------------------------------------------


def _exact(size: float, width: int) -> type:
    """Numbers in which squared distances of components up to `size`, and four times these, are exact: doubles, longs or Python's own."""
    most = 16.0 * size * size * max(1, width)
    return np.float64 if most < 2.0**53 else np.int64 if most < 2.0**62 else object


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which entries can be nearest to a value in the box low..high: a row of booleans for each box.

    An entry is out if its least distance to the box is beyond the greatest distance of another, or if the entry nearest to the
    box's middle is nearer wherever in the box the value is. Entries that may tie stay.
    """
    kind = _exact(max(float(np.abs(x).max(initial=0)) for x in (low, high, entries)), low.shape[1])
    low, high, entries = (x.astype(kind) for x in (low, high, entries))
    under, over = low[:, None, :] - entries[None], entries[None] - high[:, None, :]
    near = np.maximum(np.maximum(under, over), 0)
    far = np.maximum(np.abs(under), np.abs(over))
    least, most = (near * near).sum(axis=2), (far * far).sum(axis=2)
    stays = least <= most.min(axis=1)[:, None]
    # distance to e less distance to the middle's entry m is linear in the value: its least over the box is at a corner
    middle = low + high
    twice = 2 * entries[None] - middle[:, None, :]
    m = entries[np.argmin((twice * twice).sum(axis=2), axis=1)]
    slope = m[:, None, :] - entries[None]
    corner = np.where(slope > 0, low[:, None, :], high[:, None, :])
    gap = ((entries * entries).sum(axis=1)[None] - (m * m).sum(axis=1)[:, None]) + 2 * (slope * corner).sum(axis=2)
    return stays & (gap <= 0).astype(bool)


def nearest(values: np.ndarray, entries: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest of the chosen entries (ascending) for each value; ties to the lower index."""
    some = entries[chosen]
    kind = _exact(max(float(np.abs(values).max(initial=0)), float(np.abs(some).max(initial=0))), values.shape[1])
    a, b = values.astype(kind), some.astype(kind)
    distance = (b * b).sum(axis=1)[None] - 2 * (a @ b.T)
    best = np.argmin(distance, axis=1)
    error = distance[np.arange(len(a)), best] + (a * a).sum(axis=1)
    return chosen[best], np.array([min(int(x), _LONG.max) for x in error], dtype=np.int64) if kind is object else error.astype(np.int64)


def boxes(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest components of the blocks that begin at starts."""
    return np.minimum.reduceat(values, starts, axis=0), np.maximum.reduceat(values, starts, axis=0)


def coded(values: np.ndarray, entries: np.ndarray, curve: Curve) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) for each value, by blocks along the curve."""
    index, error = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
    if not values.shape[1]:
        return index, error
    order = np.argsort(curve.places(values), kind="stable")
    along = values[order]
    starts = np.arange(0, len(values), BLOCK)
    for at in range(0, len(starts), BOXES):
        here = starts[at : at + BOXES]
        end = min(len(values), int(here[-1]) + BLOCK)
        lists = shortlists(*boxes(along[here[0] : end], here - here[0]), entries)
        for start, chosen in zip(here, lists):
            rows = order[start : start + BLOCK]
            index[rows], error[rows] = nearest(along[start : start + BLOCK], entries, np.flatnonzero(chosen))
    return index, error


# blocks ---------------------------------------------------------------------------------------------------------------

_VALUES = "part int, place long, value binary"
_BLOCKS = "part int, n int, low binary, high binary, total binary, times binary, value binary"


def blocks(vectors: DataFrame, curves: list[Curve], width: int) -> DataFrame:
    """The blocks of all parts; vectors: q. Equal values of a part are one value, so that copies cost one row."""
    part = width // PARTS

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = matrix(batch["q"], width)
            for p in range(PARTS):
                own = np.ascontiguousarray(rows[:, p * part : (p + 1) * part])
                yield pd.DataFrame({"part": p, "place": curves[p].places(own), "value": [x.tobytes() for x in own]})

    def laid_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by part and place; what does not fill a block waits for the next batch."""
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = batch["part"] == batch["part"].iloc[-1]
            keep = int(last.sum()) % BLOCK
            rest, batch = batch.iloc[len(batch) - keep :], batch.iloc[: len(batch) - keep]
            yield _laid_out(batch, part)
        if rest is not None:
            yield _laid_out(rest, part)

    values = vectors.select("q").mapInPandas(cut_up, _VALUES).groupBy("part", "place", "value").agg(F.count("*").alias("times"))
    along = values.repartitionByRange("part", "place", F.xxhash64("value")).sortWithinPartitions("part", "place", "value")
    return along.select("part", "value", "times").mapInPandas(laid_out, _BLOCKS)


def _laid_out(rows: pd.DataFrame, width: int) -> pd.DataFrame:
    out = []
    for p, own in rows.groupby("part"):
        values = np.frombuffer(b"".join(own["value"]), "<i8").reshape(len(own), width)
        times = own["times"].to_numpy(np.int64)
        for at in range(0, len(own), BLOCK):
            v, t = values[at : at + BLOCK], times[at : at + BLOCK]
            total = (v.astype(object) * t[:, None]).sum(axis=0) if float(np.abs(v).max(initial=0)) * float(t.sum()) > 2.0**62 else (v * t[:, None]).sum(axis=0)
            total = b"".join(int(x).to_bytes(16, "little", signed=True) for x in total)
            out.append((p, len(v), v.min(axis=0).tobytes(), v.max(axis=0).tobytes(), total, t.tobytes(), v.tobytes()))
    return pd.DataFrame(out, columns=["part", "n", "low", "high", "total", "times", "value"])


def sums(stored: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(part, entry, place, total, n): the sum of the values nearest to each entry by component, and how many there are.

    The codebooks, of a fixed size, go with the task. A task returns one row for each entry and component at most.
    """
    width = books[0].shape[1]

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [[[0] * width for _ in book] for book in books]
        count = [[0] * len(book) for book in books]
        for batch in batches:
            for p, own in batch.groupby("part"):
                for at in range(0, len(own), BOXES):
                    _add(own.iloc[at : at + BOXES], books[p], total[p], count[p])
        rows = [(p, e, d, t, n) for p in range(len(books)) for e, n in enumerate(count[p]) if n for d, t in enumerate(total[p][e])]
        yield pd.DataFrame([(p, e, d, str(t), n) for p, e, d, t, n in rows], columns=["part", "entry", "place", "total", "n"])

    found = stored.mapInPandas(added, "part int, entry int, place int, total string, n long")
    return found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def _add(own: pd.DataFrame, book: np.ndarray, total: list[list[int]], count: list[int]) -> None:
    width = book.shape[1]
    low, high = (np.frombuffer(b"".join(own[c]), "<i8").reshape(len(own), width) for c in ("low", "high"))
    for row, chosen in zip(own.itertuples(index=False), shortlists(low, high, book)):
        chosen = np.flatnonzero(chosen)
        times = np.frombuffer(row.times, "<i8")
        if len(chosen) == 1:  # the whole block is nearest to one entry: its sum is enough
            e = int(chosen[0])
            count[e] += int(times.sum())
            own_total = total[e]
            for d in range(width):
                own_total[d] += int.from_bytes(row.total[16 * d : 16 * d + 16], "little", signed=True)
            continue
        values = np.frombuffer(row.value, "<i8").reshape(row.n, width)
        index, _ = nearest(values, book, chosen)
        small = float(np.abs(values).max(initial=0)) * float(times.sum()) < 2.0**62
        weighed = values * times[:, None] if small else values.astype(object) * times[:, None].astype(object)
        for e in np.unique(index).tolist():
            here = index == e
            count[e] += int(times[here].sum())
            total[e] = [a + int(b) for a, b in zip(total[e], weighed[here].sum(axis=0))]


# codebooks and codes ----------------------------------------------------------------------------------------------------


class Codebooks:
    """One array of entries for each part, and the curve that their blocks lie along."""

    def __init__(self, books: list[np.ndarray], curves: list[Curve]):
        self.books, self.curves = books, curves

    @property
    def width(self) -> int:
        return PARTS * self.books[0].shape[1]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for book in self.books for x in book.ravel()).encode()).hexdigest()


def codebooks(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> Codebooks | None:
    """Codebooks fitted to all vectors (as quantised() gives them); None without vectors."""
    spark = vectors.sparkSession
    longest = vectors.agg(F.max(F.size("q")).alias("n")).first()["n"]
    if longest is None:
        return None
    width = -(-longest // PARTS) * PARTS
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "q").limit(entries).select("q").collect()  # of a fixed number
    rows = matrix(pd.Series([r["q"] for r in first]), width)
    books = [part.copy() for part in np.split(rows, PARTS, axis=1)]
    curves = [Curve(book) for book in books]
    if not width:
        return Codebooks(books, curves)
    folder = f"{shared_folder(spark)}/blocks-{uuid.uuid4().hex}"
    try:
        blocks(vectors, curves, width).write.parquet(folder)
        stored = spark.read.parquet(folder)
        for _ in range(rounds):
            new = [book.copy() for book in books]
            for r in sums(stored, books).collect():
                new[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
            books = new
    finally:
        removed(spark, folder)
    return Codebooks(books, curves)


def codes(vectors: DataFrame, found: Codebooks) -> DataFrame:
    """id, label, code and error for each vector (as quantised() gives them)."""
    shared = vectors.sparkSession.sparkContext.broadcast(found)  # of a fixed size
    part = found.width // PARTS

    def given(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            rows = matrix(batch["q"], own.width)
            each = [coded(np.ascontiguousarray(rows[:, p * part : (p + 1) * part]), own.books[p], own.curves[p]) for p in range(PARTS)]
            digits = np.array([index for index, _ in each], dtype=np.uint8).T
            error = np.minimum(sum(np.minimum(e, _LONG.max // PARTS) for _, e in each), _LONG.max)
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "code": [x.tobytes().hex() for x in digits], "error": error})

    kinds = dict(vectors.dtypes)
    return vectors.select("id", "label", "q").mapInPandas(given, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def compressed(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 for each row of embeddings that takes part."""
    vectors = quantised(embeddings)
    found = codebooks(vectors)
    if found is None:
        return vectors.select(F.col("id").alias("vec_id"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256")).limit(0)
    # null labels are a label of their own, which a join on the label alone would lose
    rows = cut(codes(vectors, found).withColumn("named", F.col("label").isNotNull()).withColumn("label", F.coalesce("label", F.lit(0).cast(vectors.schema["label"].dataType))))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    held = F.least(total, F.lit(_LONG.max).cast("decimal(38,0)")).cast("long")
    labels = cut(rows.groupBy("label", "named").agg(held.alias("label_error"), F.count("*").alias("n")))
    joined = join_hot(rows, labels.drop("n"), ["label", "named"], labels, F.xxhash64("id", "code"))
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))
