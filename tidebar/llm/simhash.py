"""SimHash near-duplicates, compared on bit planes.

A fingerprint has a bit for each of 64 positions: whether over half of the
hashes of a text's shingles have it. Two fingerprints that differ in at most
RADIUS = 2 of 64 bits agree on two of four 16-bit quarters at least, so every
link is found among the fingerprints that share one of the six pairs of
quarters. Those of one bucket are laid out as bit planes, a lane for each
fingerprint; a fingerprint is compared with blocks of 64 lanes by adding the
planes' differences into two carry-save counters, and a block is left once
every lane of it is beyond the radius. The two quarters that a bucket shares are not compared.

Equal fingerprints are merged before (a group of copies is one row), and a
large bucket is cut into tiles of bounded size whose pairs go to tasks of their
own. Of the links in a tile a forest is kept, which joins the same fingerprints.

Null and empty texts, and those of white space alone, have fingerprint zero
and are linked like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fresh, join_hot
from .components import stars

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Fingerprints of a bucket that one side of a tile has at most, about; larger buckets become more tiles.
TILE = 4096
#: The pairs of quarters, by number.
QUARTERS = tuple(combinations(range(4), 2))


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z alone, and ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.array([xxhash.xxh64_intdigest(part, SEED) for part in parts], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        counts += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


@F.pandas_udf(T.LongType())
def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The fingerprint as a signed long."""
    for series in texts:
        yield pd.Series(np.array([fingerprint_of(t) for t in series], dtype=np.uint64).view(np.int64))


def planes_of(prints: np.ndarray) -> np.ndarray:
    """(64, n / 64) words: bit l of word w in plane b is bit b of fingerprint 64 w + l."""
    bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within(planes: np.ndarray, asked: np.ndarray, words: np.ndarray, lanes: np.ndarray, bits: int = 64, left: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which lanes of a block are within the radius of the fingerprint that is compared with the block.

    One block for each entry of the three arrays: asked, the fingerprint; words, the word of the planes that holds the
    block's 64 lanes; lanes, those of them that count. Planes from `bits` on are known to agree. The differing planes are
    added into two carry-save counters (ones and twos, with a mark for what is over), and a block is left as soon as all
    its lanes are beyond the radius. Returns entry numbers and lanes (64 * word + bit); `left` collects, for each
    look, how many blocks there were and how many were left.
    """
    at = np.arange(len(asked))
    ones, twos, over = (np.zeros(len(asked), np.uint64) for _ in range(3))
    for b in range(bits):
        differ = planes[b][words] ^ (np.uint64(0) - ((asked >> np.uint64(b)) & np.uint64(1)))
        carry = ones & differ
        ones ^= differ
        over |= twos & carry
        twos ^= carry
        if b % 4 == 3:
            stays = ((~(over | (ones & twos))) & lanes) != 0
            if left is not None:
                left.append((len(stays), int(len(stays) - stays.sum())))
            if not stays.all():
                at, asked, words, lanes, ones, twos, over = (x[stays] for x in (at, asked, words, lanes, ones, twos, over))
                if not len(at):
                    break
    near = ~(over | (ones & twos)) & lanes
    some = np.flatnonzero(near)
    k, lane = np.nonzero(np.unpackbits(near[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return at[some[k]], words[some[k]].astype(np.int64) * 64 + lane


def _turned(prints: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """The fingerprints with the quarters of the given pairs put last: those agree within a bucket, so that only 32 planes can differ."""
    out = np.zeros(len(prints), np.uint64)
    for n, chosen in enumerate(QUARTERS):
        here = pair == n
        for place, q in enumerate([q for q in range(4) if q not in chosen] + list(chosen)):
            out[here] |= ((prints[here] >> np.uint64(16 * q)) & np.uint64(0xFFFF)) << np.uint64(16 * place)
    return out


def _first_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of the first pair of quarters on which the fingerprints agree."""
    same = [((a ^ b) >> np.uint64(16 * q)) & np.uint64(0xFFFF) == 0 for q in range(4)]
    out = np.full(len(a), len(QUARTERS))
    for n, (p, q) in reversed(list(enumerate(QUARTERS))):
        out[same[p] & same[q]] = n
    return out


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n items the least item that it is joined to by links a-b."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        was = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        np.minimum.at(label, was[a], least)
        np.minimum.at(label, was[b], least)
        label = label[label]
        if (label == was).all():
            return label


#: Blocks that are compared at a time, at most, about: 40 bytes of working memory each.
STEP = 1 << 18


def _blocks(starts: np.ndarray, sizes: np.ndarray, firsts: np.ndarray) -> Iterator[tuple]:
    """Entries for within(), in steps: (rows asked, lane places, words, lanes) of groups of rows; small groups share words.

    firsts: how many rows of a group are asked; they are compared with the rest of the group. Where that is all of the
    group, each row is compared with those after it.
    """
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    rows, words, lanes, places, filled, entries = [], [], [], [], 0, 0
    for s, n, first in zip(starts.tolist(), sizes.tolist(), firsts.tolist()):
        if n < 2 or not first:
            continue
        if filled % 64 and filled % 64 + n > 64:  # no group of up to 64 lies across two words
            filled += -filled % 64
        begin = filled
        places.append((s, begin, n))
        filled += n
        last = (filled - 1) // 64
        after = np.arange(1, n + 1) + begin if first == n else np.full(first, begin + first)  # each row's first lane to meet
        after = after[: min(first, n - 1)]
        count = last - after // 64 + 1
        row = np.repeat(np.arange(len(after)), count)
        word = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + (after // 64)[row]
        mask = np.full(len(row), full)
        head = word == (after // 64)[row]
        mask[head] &= full << (after[row[head]] % 64).astype(np.uint64)
        mask[word == last] &= full >> np.uint64(63 - (filled - 1) % 64)
        rows.append(row + s)
        words.append(word)
        lanes.append(mask)
        entries += len(row)
        if entries >= STEP:
            yield rows, words, lanes, places, filled
            rows, words, lanes, places, filled, entries = [], [], [], [], 0, 0
    if entries:
        yield rows, words, lanes, places, filled


def _links(prints: np.ndarray, groups: np.ndarray, pair: np.ndarray, side: np.ndarray | None = None, left: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints of the same group, as a forest.

    Rows come sorted by group, then side; pair: the group's pair of quarters. A group with both sides (0 and 1) is
    compared across them alone, any other within itself.
    """
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[starts, len(groups)])
    firsts = sizes if side is None else sizes - np.add.reduceat(side.astype(np.int64), starts)
    firsts = np.where(firsts == 0, sizes, firsts)
    turned = _turned(prints, pair)
    a, b = [], []
    for rows, words, lanes, places, filled in _blocks(starts, sizes, firsts):
        packed, back = np.zeros(filled + -filled % 64, np.uint64), np.zeros(filled + -filled % 64, np.int64)
        for s, begin, n in places:
            packed[begin : begin + n] = turned[s : s + n]
            back[begin : begin + n] = np.arange(s, s + n)
        planes, row, word, lane = planes_of(packed), np.concatenate(rows), np.concatenate(words), np.concatenate(lanes)
        for at in range(0, len(row), STEP):
            part = slice(at, at + STEP)
            k, place = within(planes, turned[row[part]], word[part], lane[part], 32, left)
            a.append(row[part][k])
            b.append(back[place])
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(a), np.concatenate(b)
    first = _first_pair(prints[a], prints[b]) == pair[a]  # each link once, in the first bucket that has it
    label = _forest(len(prints), a[first], b[first])
    joined = np.flatnonzero(label != np.arange(len(prints)))
    return joined, label[joined]


def _linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links in each tile; rows come sorted by tile, and a tile may go on in the next batch."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        tile = batch[_TILE].to_numpy()
        if rest and (rest[-1][_TILE].iloc[-1].to_numpy() != tile[0]).any():
            yield _tile_links(pd.concat(rest, ignore_index=True))
            rest = []
        last = np.flatnonzero((tile != tile[-1]).any(axis=1))
        if len(last):
            yield _tile_links(pd.concat([*rest, batch.iloc[: int(last[-1]) + 1]], ignore_index=True))
            rest = [batch.iloc[int(last[-1]) + 1 :]]
        else:
            rest.append(batch)
    if rest:
        yield _tile_links(pd.concat(rest, ignore_index=True))


_TILE = ["pair", "key", "i", "j"]


def _tile_links(rows: pd.DataFrame) -> pd.DataFrame:
    tile = rows[_TILE].to_numpy()
    groups = np.cumsum(np.r_[False, (tile[1:] != tile[:-1]).any(axis=1)])
    prints = rows["fp"].to_numpy(dtype=np.int64)
    a, b = _links(prints.view(np.uint64), groups, tile[:, 0], rows["side"].to_numpy())
    return pd.DataFrame({"x": prints[a], "y": prints[b]})


def links(prints: DataFrame) -> DataFrame:
    """(x, y): fingerprints within the radius, as a forest of each tile. prints: distinct non-null longs in fp."""
    quarter = [F.shiftrightunsigned("fp", 16 * q).bitwiseAND(0xFFFF) for q in range(4)]
    pairs = F.array(*(F.struct(F.lit(n).alias("pair"), (F.shiftleft(quarter[p], 16).bitwiseOR(quarter[q])).alias("key")) for n, (p, q) in enumerate(QUARTERS)))
    keyed = prints.select("fp", F.explode(pairs).alias("k")).select("fp", "k.pair", "k.key")
    sizes = keyed.groupBy("pair", "key").agg(F.count("*").alias("n")).where("n > 1")
    # a bucket of n rows has t = ceil(n / TILE) parts: tile (i, i) is part i by itself, tile (i, j) is part i against part j
    tiled = (
        join_hot(keyed, sizes, ["pair", "key"], sizes, F.xxhash64("fp"))
        .withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
        .select("fp", "pair", "key", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .select("fp", "pair", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    )
    spread = tiled.repartition("pair", "key", "i", "j").sortWithinPartitions("pair", "key", "i", "j", "side")
    return spread.mapInPandas(_linked, "x long, y long")


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (least doc_id reachable), a row for each row of docs.

    Null, empty and blank texts have fingerprint zero; a long text is one row of its batch, hashed shingle by shingle. A
    row with a null doc_id keeps its place; ids of null are not reported as anybody's least. Rows that repeat are
    linked to each other, so that ties have one component. No rows give none; other columns, of any name, play no part.
    """
    prints = cut(docs.select("doc_id", fingerprint(F.col(text)).alias("fp")))
    classes = _classes(prints)
    met = join_hot(prints, _members(classes), ["fp"], classes, F.xxhash64("doc_id", F.monotonically_increasing_id()), "left")
    return met.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _classes(prints: DataFrame) -> DataFrame:
    """fp, least (the least doc_id) and n (rows) of each fingerprint of prints (doc_id, fp)."""
    return cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))


def _members(classes: DataFrame) -> DataFrame:
    """fp, root (the fingerprint that stands for its component) and component_id, a row for each fingerprint."""
    rooted = stars(links(classes.select("fp")), "x", "y")
    grouped = classes.join(rooted, classes["fp"] == rooted["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    moved = grouped.where("root <> fp")
    roots = moved.groupBy("root").agg(F.min("least").alias("below"), F.count("*").alias("n"))
    least = classes.join(roots.select("root", "below"), classes["fp"] == F.col("root")).select("root", F.least("least", "below").alias("component_id"))
    # a root stands for itself, so that `least` meets it too
    met = join_hot(grouped, least, ["root"], roots, F.xxhash64("fp"), "left")
    return met.select("fp", "root", F.coalesce("component_id", "least").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of docs for each component, that with the least doc_id in it, with its own columns.

    Of several such rows (an id that repeats) that with the least fingerprint, then the least hash of its text, stays;
    rows that are alike in all three count as one. Rows without doc_id have no least id and stay, all of them. No rows give none.
    """
    own, name = F.xxhash64(F.coalesce("text", F.lit(""))), fresh(docs, "_own")
    prints = cut(docs.where("doc_id is not null").select("doc_id", fingerprint(F.col("text")).alias("fp"), own.alias("hash")))
    classes = _classes(prints)
    met = join_hot(prints, _members(classes), ["fp"], classes, F.xxhash64("doc_id", "hash"))
    kept = met.where("doc_id = component_id").groupBy("root").agg(F.min(F.struct("doc_id", "fp", "hash")).alias("k"))
    kept = cut(kept.select(*(F.col(f"k.{a}").alias(b) for a, b in zip(("doc_id", "fp", "hash"), ("_kept", "_fp", "_hash")))))
    # a row is found by its id and the hash of its text, which the scan has; the fingerprint follows from the text
    chosen = kept.select("_kept", "_hash").distinct()
    found = docs.withColumn(name, own).join(chosen, (docs["doc_id"] == chosen["_kept"]) & (F.col(name) == chosen["_hash"]), "left_semi")
    repeats = prints.join(chosen, (prints["doc_id"] == chosen["_kept"]) & (prints["hash"] == chosen["_hash"]), "left_semi").groupBy("doc_id", "hash").agg(F.count("*").alias("n")).where("n > 1")
    repeats = cut(repeats)
    if not repeats.isEmpty():
        twice = repeats.select(F.col("doc_id").alias("_kept"), F.col("hash").alias("_hash"))
        same = (found["doc_id"] == twice["_kept"]) & (found[name] == twice["_hash"])
        found = found.join(twice, same, "left_anti").unionByName(found.join(twice, same, "left_semi").dropDuplicates(["doc_id", name]))
    return found.drop(name).unionByName(docs.where("doc_id is null"))
