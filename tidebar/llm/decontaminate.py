"""Benchmark decontamination with suffix arrays of the training texts.

Documents are dealt into shards of bounded size, within the batches that Spark
hands out. Of each shard a suffix array is built over its own vocabulary, whatever
the benchmark. Every different suffix of the benchmark items is then searched in it by binary
search, word by word; where a whole window is found, all its occurrences lie side
by side. Windows that are alike in any items are one, so that a text has as many occurrences as places (for
each length of window), whatever it repeats. Occurrences that follow one another are joined to longest matches, with
their places, and documents are judged by the words that are hit.

The benchmark comes in blocks of at most BLOCK_WORDS words, one after another through
the driver, which broadcasts PASS_BLOCKS of them at most; a worker has one of these open at a time, and a benchmark of
more goes over the documents in several passes. Documents are not shuffled.

Null and empty texts have no words; a long text is a shard of its own. Items without
words have no window. Items that repeat an item_id count once for it; a null item_id is
not reported, but its windows hit. Rows that repeat give the same result each.
Empty tables give empty results, or no hits. Columns of any other name stay.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fresh

WINDOW = 13
#: A document is contaminated if one word in so many is hit.
SHARE = 20
BLOCK_WORDS = 400_000
#: Blocks that are broadcast together.
PASS_BLOCKS = 8
#: Pairs of places in a text and in items that are laid out at once.
PAIRS = 1_000_000
#: Characters in a shard, about: its suffix array takes some ten bytes for each.
SHARD_CHARS = 8_000_000

#: A-Z to a-z, and every other ASCII character that is no digit or letter to a blank.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32) for c in range(256))

MATCH = T.StructType([T.StructField(n, T.LongType()) for n in ("item_id", "words", "doc_word", "item_word")])
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("hit", T.BinaryType()),
        T.StructField("items", T.ArrayType(MATCH)),
    ]
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def suffix_array(ids: np.ndarray, first_word: int) -> np.ndarray:
    """The places of ids in the order of their suffixes, by doubling the length that is in order.

    Numbers below first_word end a text and stand once each, so that order is settled where a text ends. From each
    length to the next only suffixes that still tie are sorted anew.
    """
    n = len(ids)
    sa = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.r_[True, ids[sa][1:] != ids[sa][:-1]])
    group = np.repeat(starts, np.diff(np.r_[starts, n]))  # of each slot, the first slot of its tie
    rank = np.empty(n + 1, np.int64)  # the same of each place; beyond the end, below all
    rank[sa], rank[n] = group, -1
    slots = np.flatnonzero(np.r_[group[1:] == group[:-1], False] | np.r_[False, group[1:] == group[:-1]])
    length = 1
    while len(slots):
        places = sa[slots]
        behind = rank[np.minimum(places + length, n)]
        order = np.argsort(group[slots] * (n + 2) + behind + 1, kind="stable")
        key = (group[slots] * (n + 2) + behind + 1)[order]
        places = places[order]
        new = np.r_[True, key[1:] != key[:-1]]
        head = slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        sa[slots], group[slots] = places, head
        rank[places] = head
        tied = np.r_[~new[1:], False] | ~new
        slots = slots[tied]
        length *= 2
    return sa


class Shard:
    """Some texts with a vocabulary and a suffix array of their own, whatever is looked up in them later."""

    def __init__(self, texts: list[str | None]):
        words = [words_of(t) for t in texts]
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        self.ends = np.cumsum(self.sizes + 1) - 1  # each text's end has a number of its own, below all words
        self.starts = self.ends - self.sizes
        self.vocabulary: dict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = lambda: len(self.vocabulary) + len(words)
        self.ids = np.empty(int(self.ends[-1]) + 1 if len(words) else 0, np.int64)
        for k, (text, start) in enumerate(zip(words, self.starts.tolist())):
            self.ids[start : start + len(text)] = np.fromiter(map(self.vocabulary.__getitem__, text), np.int64, len(text))
            self.ids[start + len(text)] = k
        self.array = suffix_array(self.ids, len(words))

    def _narrow(self, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slots within [low, high), all alike in their first depth words, whose next word is the given one: binary search, all at once."""
        out = []
        for bound in (word, word + 1):
            a, b = low.copy(), high.copy()
            while (go := a < b).any():
                middle = (a + b) // 2
                here = self.ids[np.minimum(self.array[np.minimum(middle, len(self.array) - 1)] + depth, len(self.ids) - 1)]
                less = go & (here < bound)
                a = np.where(less, middle + 1, a)
                b = np.where(go & ~less, middle, b)
            out.append(a)
        return out[0], out[1]

    def occurrences(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(window, place in the shard): everywhere that a window of the block stands, each with its number there.

        One suffix of each different window is searched, one word deeper at each step; suffixes that are found
        nowhere drop out. Windows of one length are different wherever they stand, so that there are as many
        occurrences as places for each length at most.
        """
        known = np.fromiter(map(self.vocabulary.get, block.vocabulary, repeat(-1)), np.int64, len(block.vocabulary))
        at = block.first
        number = np.arange(len(at))
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.array))
        done: list[tuple] = []
        for depth in range(block.window):
            word = known[block.ids[at + depth]]
            there = word >= 0
            number, at, low, high, word = number[there], at[there], low[there], high[there], word[there]
            if not len(at):
                break
            low, high = self._narrow(low, high, depth, word)
            some = low < high
            number, at, low, high = number[some], at[some], low[some], high[some]
            full = block.lengths[at] == depth + 1
            done.append((number[full], low[full], high[full]))
            number, at, low, high = number[~full], at[~full], low[~full], high[~full]
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        number, low, high = (np.concatenate(x) for x in zip(*done))
        count = high - low
        slot = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(int(count.sum()))
        return np.repeat(number, count), self.array[slot]


class Block:
    """Words of some benchmark items one after another; lengths: of each place, the length of the window that begins there, or 0.

    number: of each place, which window begins there, alike for equal windows (-1: none); first: of each window, its first place.
    items_of (with bounds): of each window, the named places where it stands, without those of items that repeat a window
    (repeats), which are compared as wholes.
    """

    def __init__(self, items: list[tuple[int | None, int, list[bytes], bool]], window: int = WINDOW):
        """items: id, place of the first word within the item, words, and whether these are a part of a longer item."""
        self.window = window
        vocabulary: dict[bytes, int] = {}
        ids, lengths, owner, place = [], [], [], []
        for n, (_, first, words, part) in enumerate(items):
            size = window if part else min(window, len(words))
            ids += [vocabulary.setdefault(w, len(vocabulary)) for w in words]
            lengths += [size if i + size <= len(words) and size else 0 for i in range(len(words))]
            owner += [n] * len(words)
            place += range(first, first + len(words))
        self.vocabulary = list(vocabulary)
        self.ids, self.lengths, self.owner, self.place = (np.array(x, dtype=np.int64) for x in (ids, lengths, owner, place))
        self.items = [item for item, *_ in items]
        self.codes = np.array([-1 if i is None else i for i in self.items], dtype=np.int64)
        self.null = np.array([i is None for i in self.items], dtype=bool)
        numbers: dict[bytes, int] = {}
        raw = self.ids.astype(np.int32)
        self.number = np.array([numbers.setdefault(raw[i : i + n].tobytes(), len(numbers)) if n else -1 for i, n in enumerate(self.lengths.tolist())], dtype=np.int64)
        starts = np.flatnonzero(self.number >= 0)
        self.first = np.zeros(len(numbers), np.int64)
        self.first[self.number[starts][::-1]] = starts[::-1]
        self.size = self.lengths[self.first]
        named = starts[~self.null[self.owner[starts]]] if len(starts) else starts
        pair = self.owner[named] * (len(numbers) + 1) + self.number[named]
        _, back, times = np.unique(pair, return_inverse=True, return_counts=True)
        self.repeats = np.unique(self.owner[named][times[back] > 1])
        of_repeats = np.isin(self.owner[named], self.repeats)
        self.items_of, self.bounds = self._by_window(named[~of_repeats], len(numbers))
        self.repeated_of, self.repeated_bounds = self._by_window(named[of_repeats], len(numbers))

    def _by_window(self, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(self.number[places], kind="stable")
        return places[order], np.searchsorted(self.number[places][order], np.arange(n + 1))


def longest_common(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(length, place in a, place in b) of the longest run of numbers that both have, the first in a, then in b; negative numbers match nothing.

    By ranks of runs of doubling length: time and room in proportion to both (and the logarithm of the length).
    """
    both = np.r_[a, -1, b]
    both = np.where(both < 0, -1 - np.arange(len(both)), both)
    places_b = np.arange(len(a) + 1, len(both))
    _, rank = np.unique(both, return_inverse=True)
    levels = [rank]

    def common(rank: np.ndarray) -> bool:
        return bool(len(np.intersect1d(rank[: len(a)], rank[places_b])))

    if not common(rank):
        return 0, 0, 0

    def joined(x: np.ndarray, y: np.ndarray, by: int) -> np.ndarray:
        """Ranks of runs: those of x, and of y so many places on; runs beyond the end are like no other."""
        behind = np.full(len(y), -1)
        behind[: max(0, len(y) - by)] = y[by:]
        missing = behind < 0
        behind[missing] = y.max() + 1 + np.flatnonzero(missing)
        return np.unique(x.astype(np.int64) * (int(behind.max()) + 1) + behind, return_inverse=True)[1]

    while common(new := joined(levels[-1], levels[-1], 1 << (len(levels) - 1))):
        levels.append(new)
    length, best = 1 << (len(levels) - 1), levels[-1]
    for k in range(len(levels) - 2, -1, -1):
        if common(new := joined(best, levels[k], length)):
            length, best = length + (1 << k), new
    at = int(np.flatnonzero(np.isin(best[: len(a)], best[places_b]))[0])
    return length, at, int(np.flatnonzero(best[places_b] == best[at])[0])


def _runs(what: np.ndarray, where: np.ndarray, shard: Shard, block: Block) -> Iterator[tuple]:
    """(text, item, words, doc_word, item_word) from places in the block and in the shard: of each text and item the longest run.

    Windows that follow one another in a text and an item alike are one match.
    """
    size = block.lengths[what]
    order = np.lexsort((where, where - what))
    what, where, size = what[order], where[order], size[order]
    text, owner = np.searchsorted(shard.ends, where), block.owner[what]
    new = np.r_[True, (np.diff(where - what) != 0) | (np.diff(where) != 1) | (np.diff(text) != 0) | (np.diff(owner) != 0)] if len(what) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    words = np.diff(np.r_[first, len(what)]) - 1 + size[first]
    text, item = text[first], block.codes[owner[first]]
    at, in_item = where[first] - shard.starts[text], block.place[what[first]]
    best = np.lexsort((in_item, at, -words, item, text))
    top = best[np.r_[True, (np.diff(text[best]) != 0) | (np.diff(item[best]) != 0)]] if len(best) else best
    return zip(*(x[top].tolist() for x in (text, item, words, at, in_item)))


def matches(shard: Shard, block: Block) -> tuple[np.ndarray, list[tuple]]:
    """A boolean for each place of the shard (hit or not), and (text, item, words, doc_word, item_word): each text's longest match of each item.

    Of equally long ones the first in the text, then in the item, counts. Places of texts and items meet in parts of
    PAIRS pairs; a text with more, and an item that repeats a window, are compared as two sequences instead.
    """
    hit = np.zeros(len(shard.ids) + 1, np.int64)
    window, where = shard.occurrences(block)
    if not len(window):
        return hit[:-1] > 0, []
    np.add.at(hit, where, 1)
    np.add.at(hit, where + block.size[window], -1)
    order = np.argsort(where, kind="stable")
    window, where = window[order], where[order]
    text = np.searchsorted(shard.ends, where)
    heads = np.flatnonzero(np.r_[True, np.diff(text) != 0])
    tails = np.r_[heads[1:], len(text)]
    pairs = (block.bounds[1:] - block.bounds[:-1])[window]
    by_text = np.add.reduceat(pairs, heads)
    found, start, held = [], 0, 0

    def together(a: int, b: int) -> None:
        """The texts of heads a to b, in one layout of pairs."""
        here = slice(heads[a], tails[b - 1])
        n = pairs[here]
        at = np.repeat(block.bounds[window[here]] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))
        found.extend(_runs(block.items_of[at], np.repeat(where[here], n), shard, block))

    for k, more in enumerate(by_text.tolist()):
        if held and held + more > PAIRS:
            together(start, k)
            held = 0
        if not held:
            start = k
        if more > PAIRS:
            found += _as_sequences(shard, block, window[heads[k] : tails[k]], where[heads[k] : tails[k]], int(text[heads[k]]), block.items_of, block.bounds)
        else:
            held += more
    if held:
        together(start, len(heads))
    if len(block.repeats):
        some = np.unique(text[(block.repeated_bounds[1:] - block.repeated_bounds[:-1])[window] > 0])
        for k in np.searchsorted(text[heads], some).tolist():
            found += _as_sequences(shard, block, window[heads[k] : tails[k]], where[heads[k] : tails[k]], int(text[heads[k]]), block.repeated_of, block.repeated_bounds)
    return np.cumsum(hit[:-1]) > 0, found


def _as_sequences(shard: Shard, block: Block, window: np.ndarray, where: np.ndarray, text: int, places: np.ndarray, bounds: np.ndarray) -> list[tuple]:
    """The same for one text and each item that has one of its windows among the given places."""
    start, size = int(shard.starts[text]), int(shard.sizes[text])
    owners: set[int] = set()
    for w in np.unique(window).tolist():
        owners.update(block.owner[places[bounds[w] : bounds[w + 1]]].tolist())
    whole = block.size[window] == block.window
    own = np.full(size, -1, np.int64)
    own[where[whole] - start] = window[whole]
    out, known = [], {}
    for owner in sorted(owners):
        mine = np.arange(*np.searchsorted(block.owner, (owner, owner + 1)))  # items stand one after another
        mine = mine[block.lengths[mine] > 0]
        numbers = block.number[mine]
        key = numbers.tobytes()
        if key not in known:
            if block.size[numbers[0]] < block.window:  # a short item is one window
                known[key] = (1, int(where[window == numbers[0]][0]) - start, 0)
            else:
                known[key] = longest_common(own, numbers)
        n, at, inside = known[key]
        out.append((text, int(block.codes[owner]), n - 1 + int(block.size[numbers[0]]), at, int(block.place[mine[inside]])))
    return out


def blocks(benchmark: DataFrame, window: int = WINDOW, size: int = BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark in blocks of `size` words at most; one is held at a time.

    An item that is longer is cut into parts that share window - 1 words, so that no window is lost; of a match
    across a cut the longer part counts.
    """
    items, n = [], 0
    for item, text in benchmark.select("item_id", "text").toLocalIterator():
        words = words_of(text)
        step = max(1, size - window + 1)
        parts = [(item, 0, words, False)] if len(words) <= size else [(item, at, words[at : at + size], True) for at in range(0, len(words) - window + 1, step)]
        for part in parts:
            if items and n + len(part[2]) > size:
                yield Block(items, window)
                items, n = [], 0
            items.append(part)
            n += len(part[2])
    if items:
        yield Block(items, window)


def found_in(texts: list[str | None], benchmark: list, before: list[dict | None] | None = None) -> list[dict]:
    """What the blocks (broadcast, each opened when it is needed and then let go) have of each text; one suffix array serves all of them.

    before: what an earlier pass found.
    """
    shard = Shard(texts)
    hit = np.zeros(len(shard.ids), bool)
    longest: list[dict] = [{} for _ in texts]
    for k, was in enumerate(before or []):
        if was is not None:
            longest[k] = {m["item_id"]: [m[c] for c in MATCH.names[1:]] for m in was["items"]}
            if was["hit"] is not None:
                hit[shard.starts[k] : shard.ends[k]] = np.unpackbits(np.frombuffer(was["hit"], np.uint8), count=int(shard.sizes[k])).astype(bool)
    for shared in benchmark:
        more, rows = matches(shard, pickle.loads(shared.value))
        hit |= more
        for text, item, *match in rows:
            if item not in longest[text] or match[0] > longest[text][item][0]:
                longest[text][item] = match
    out = []
    for start, n, items in zip(shard.starts.tolist(), shard.sizes.tolist(), longest):
        own = hit[start : start + n]
        some = int(own.sum())
        out.append({"n_words": n, "n_hit": some, "hit": np.packbits(own).tobytes() if some else None, "items": [dict(zip(MATCH.names, (i, *m))) for i, m in items.items()]})
    return out


def _shards(series: list[str | None]) -> Iterator[slice]:
    """A batch in parts of so many characters, or one text."""
    start, n = 0, 0
    for k, text in enumerate(series):
        size = len(text) if isinstance(text, str) else 0
        if k > start and n + size > SHARD_CHARS:
            yield slice(start, k)
            start, n = k, 0
        n += size
    if len(series) > start:
        yield slice(start, len(series))


def _searcher(shared: list):
    """A function from a text and what was found before to what is found."""

    @F.pandas_udf(FOUND)
    def search(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        for series, before in batches:
            texts = [t if isinstance(t, str) else None for t in series]
            known = [None if n is None or n != n else {"hit": h, "items": i} for n, h, i in zip(before["n_words"], before["hit"], before["items"])]
            rows = [row for part in _shards(texts) for row in found_in(texts[part], shared, known[part])]
            yield pd.DataFrame(rows, columns=FOUND.names)

    return search


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "found") -> DataFrame:
    """docs with a column (`found`): n_words, n_hit, hit (a bitmap, null if none), items (longest match of each item).

    Columns of docs stay as they are, except one that has this name already. Documents go through one pass for PASS_BLOCKS
    blocks; between passes what was found is written, and the blocks are let go.
    """
    context = docs.sparkSession.sparkContext
    docs = docs.drop(name).withColumn(name, F.lit(None).cast(FOUND))
    waiting = blocks(benchmark)
    while True:
        shared = [context.broadcast(pickle.dumps(block)) for block in islice(waiting, PASS_BLOCKS)]
        docs = docs.withColumn(name, _searcher(shared)(F.col(text), F.col(name)))
        following = next(waiting, None)
        if following is None:
            return docs
        docs, waiting = cut(docs), chain([following], waiting)
        for block in shared:
            block.unpersist()


def n_hit(found: str = "found") -> Column:
    """Words of the document that are hit."""
    return F.coalesce(F.col(f"{found}.n_hit"), F.lit(0).cast("long"))


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of docs."""
    items = F.array_distinct(F.transform("found.items", lambda m: m["item_id"].cast("string")))
    return (
        contamination(docs.select("doc_id", "text"), benchmark)
        .select("doc_id", F.col("found.n_words").alias("n_words"), n_hit().alias("n_hit"), F.sort_array(items).alias("items"))
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
            contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
        )
    )


def contaminated(words: Column, hit: Column) -> Column:
    return (hit > 0) & (SHARE * hit >= words)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that are not contaminated, with their own columns."""
    name = fresh(docs, "_contamination")
    found = contamination(docs, benchmark, name=name)
    return found.where(~contaminated(F.col(f"{name}.n_words"), n_hit(name))).select(*(F.col(f"`{c}`") for c in docs.columns))
