"""Conversation prefix trie: a z-fast trie of turns, built in batches.

Conversations are rebuilt first (rebuilt()): each begins with turns of the first of its five. A conversation is then a
string of turns, a turn being the hash of its role and text, and its prefixes are told apart by hashes of 128 bits. Strings of more
than SEGMENT turns go on in further segments, each in the trie of its anchor, all that stands before it, so
that no row holds more than SEGMENT turns, however long a conversation is.

The trie is compacted: a node stands for the depths from its parent's extent to its own, and is stored under its handle,
the hash of that prefix of its extent whose length is two-fattest (divisible by the highest power of two) among these depths. A
string finds the node where it leaves the trie by fat binary search, a look at one handle for each halving of its length.
The first batch of strings, chosen by hash and of bounded size, makes a trie that is broadcast. All others find where they
leave it, in parallel; those that leave by the same turn go on together, in tries of their own in tasks that hold
some BUCKET_TURNS turns each. Those of a prefix with more than GROUP_TURNS come again as the next batch. The edges are expanded
to one row for each depth at the end, from the leaves up: what hangs at a place of the first trie is summed by Spark and
added where it hangs.

Turns stand in the order of `turn`, null first; turns of one number in the order of their hash. A null role or text is an
empty one. A null conv_id is no conversation: such rows play no part. Equal turns, repeated rows too, are as many turns;
equal conversations are one string with many members. A conversation may have no turns after rebuilding; it ends at the root. Long
texts are hashed and measured where they stand. The ids that end at a node go through one task for their common
hash, in order, as a stream. No rows give none, not even a root; columns of any other name play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, join_hot

#: Conversations of one head, and the bound of how many turns they share.
FAMILY, HEADS = 5, 9
#: Turns in a row of strings.
SEGMENT = 1024
#: Turn numbers that are ordered together.
SLICE = 4096
#: Strings of a batch, and turns of all of these.
BATCH, BATCH_TURNS = 2048, 50_000
#: Turns of strings that one task holds, about, and turns of a prefix that are too many for one.
BUCKET_TURNS, GROUP_TURNS = 20_000, 200_000
NOTHING = hashlib.sha256(b"").hexdigest()


# conversations --------------------------------------------------------------------------------------------------------


def head(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def ranked(messages: DataFrame) -> DataFrame:
    """conv_id, i (from 1), turn_hash and size (bytes of text) of each turn.

    Ordered within slices of turn numbers, which are counted before: no conversation is sorted as a whole.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    symbol = F.unhex(F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    part = F.coalesce(F.floor(F.col("turn") / SLICE), F.lit(-(2**62)))
    turns = messages.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", symbol.alias("turn_hash"), F.octet_length(text).cast("long").alias("size"), part.alias("part"))
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "turn_hash"))
    sizes = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = sizes.withColumn("before", before).select("conv_id", "part", "before")
    return turns.withColumn("place", place).join(first, ["conv_id", "part"]).select("conv_id", (F.col("before") + F.col("place")).alias("i"), "turn_hash", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ranked(): (conv_id, turns) for each conversation, and (conv_id, pos, turn_hash, size) of the rebuilt ones."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    eldest = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("eldest")
    known = sizes.select("conv_id", "n", eldest, head(F.col("conv_id")).alias("h"))
    known = known.join(sizes.select(F.col("conv_id").alias("eldest"), F.col("n").alias("there")), "eldest", "left")
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    known = cut(known.select("conv_id", "n", "eldest", "h", taken.alias("taken")))
    heads = turns.where(F.col("i") < HEADS).withColumnRenamed("conv_id", "eldest")
    shared = heads.join(known.select("conv_id", "eldest", "h"), "eldest").where("i <= h").select("conv_id", F.col("i").alias("pos"), "turn_hash", "size")
    rest = turns.where(F.col("i") > head(F.col("conv_id")))
    own = join_hot(rest, known.select("conv_id", "h", "taken"), ["conv_id"], known, F.col("i")).select("conv_id", (F.col("i") - F.col("h") + F.col("taken")).alias("pos"), "turn_hash", "size")
    return known.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns")), shared.unionByName(own)


def segments(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """seg, anchor, digest, conv_id, hashes, sizes, after (the anchor of the next segment, null in the last).

    A conversation of L turns has segments 0 to L / SEGMENT; the last may be empty. Equal anchors mean equal beginnings.
    """
    turn = F.struct("pos", "turn_hash", "size")
    rows = turns.select("conv_id", F.floor((F.col("pos") - 1) / SEGMENT).alias("seg"), turn.alias("turn"))
    ends = conversations.select("conv_id", F.floor(F.col("turns") / SEGMENT).alias("seg"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"))
    each = rows.union(ends).groupBy("conv_id", "seg").agg(F.sort_array(F.collect_list("turn")).alias("turns"))  # SEGMENT at most
    each = each.withColumn("digest", F.sha2(F.array_join(F.transform("turns", lambda t: F.hex(t["turn_hash"])), ""), 256))
    # an anchor is the sum of hashes of the segments before and their places, in two parts of 60 bits
    placed = F.sha2(F.concat_ws(":", F.col("seg").cast("string"), "digest"), 256)
    in_order = Window.partitionBy("conv_id").orderBy("seg")
    half = lambda at: F.conv(F.substring(placed, at, 15), 16, 10).cast("decimal(20,0)")
    so_far = [F.coalesce(F.sum(half(at)).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("string") for at in (1, 16)]
    each = each.withColumn("anchor", F.concat_ws(":", F.col("seg").cast("string"), *so_far))
    return each.select(
        "seg", "anchor", "digest", "conv_id", F.transform("turns", lambda t: t["turn_hash"]).alias("hashes"), F.transform("turns", lambda t: t["size"]).alias("sizes"), F.lead("anchor").over(in_order).alias("after")
    )


def ends_of(last: DataFrame) -> DataFrame:
    """(anchor, digest, ends): the hash of the ids that end with a string; last: anchor, digest, conv_id, the last segments.

    Ids come in order and leave nothing behind but the state of a hash.
    """

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for batch in batches:
            out = []
            for (anchor, digest), ids in batch.groupby(["anchor", "digest"], sort=False)["conv_id"]:
                text = ",".join(map(str, ids.tolist())).encode()
                if now == (anchor, digest):
                    state.update(b"," + text)
                    continue
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = (anchor, digest), hashlib.sha256(text)
            yield pd.DataFrame(out, columns=["anchor", "digest", "ends"])
        if now is not None:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=["anchor", "digest", "ends"])

    together = last.select("anchor", "digest", "conv_id").repartition("anchor", "digest").sortWithinPartitions("anchor", "digest", "conv_id")
    return together.mapInPandas(hashed, "anchor string, digest string, ends string")


def strings(parts: DataFrame) -> DataFrame:
    """One row for each different segment of an anchor: seg, anchor, digest, hashes, sizes, n (members), first (the least of these), after, ends."""
    same = ["seg", "anchor", "digest"]
    once = parts.groupBy(*same).agg(F.count("*").alias("n"), F.min("conv_id").alias("first"), F.max("after").alias("after"), F.any_value("hashes").alias("hashes"), F.any_value("sizes").alias("sizes"))
    return once.join(ends_of(parts.where("after is null")), ["anchor", "digest"], "left")


# the trie -------------------------------------------------------------------------------------------------------------


def fattest(a: int, b: int) -> int:
    """The number in (a, b] that is divisible by the highest power of two."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


def prefixes(anchor: str, hashes) -> list[bytes]:
    """Hashes of the prefixes of a string, by length: nothing, the anchor, and a turn more each."""
    out = [b"", hashlib.blake2b(anchor.encode(), digest_size=16).digest()]
    for h in hashes:
        out.append(hashlib.blake2b(out[-1] + bytes(h), digest_size=16).digest())
    return out


class Node:
    __slots__ = ("string", "start", "end", "children")

    def __init__(self, string: int, start: int, end: int):
        """string: one that runs through it; start, end: the lengths of its parent's extent and of its own."""
        self.string, self.start, self.end = string, start, end
        self.children: dict[bytes, Node] = {}  # by the hash of the first prefix beyond the extent


class Trie:
    """Strings as lists of prefix hashes; sizes: of a string's turns; done: up to which length a string is known elsewhere."""

    def __init__(self):
        self.strings: list[list[bytes]] = []
        self.sizes: list = []
        self.anchors: list[str] = []
        self.done: list[int] = []
        self.root = Node(-1, 0, 0)
        self.handles: dict[tuple[int, bytes], Node] = {}

    def _handle(self, node: Node) -> tuple[int, bytes]:
        f = fattest(node.start, node.end)
        return f, self.strings[node.string][f]

    def exit_of(self, string: list[bytes]) -> tuple[Node, Node | None, int]:
        """The deepest node whose extent the string begins with, the child on whose edge it leaves or ends (if any), and the length that is in the trie."""
        size, here, out = len(string) - 1, self.root, None
        a, b, known = 0, size, 0
        while a < b:
            f = fattest(a, b)
            node = self.handles.get((f, string[f]))
            if node is None:
                b = f - 1
            elif node.end <= size and self.strings[node.string][node.end] == string[node.end]:
                here, a = node, node.end
            else:  # it begins with the handle, not with the extent
                out, known = node, f
                break
        if out is None:
            out = self.handles and here.end < size and here.children.get(string[here.end + 1]) or None
            known = here.end + 1
        if out is None:
            return here, None, here.end
        other, low, high = self.strings[out.string], known, min(size, out.end)
        while low < high:  # the last length at which both are alike
            middle = (low + high + 1) // 2
            low, high = (middle, high) if other[middle] == string[middle] else (low, middle - 1)
        return here, out, low

    def insert(self, anchor: str, string: list[bytes], sizes, done: int = 0) -> None:
        here, out, size = self.exit_of(string)
        if size == len(string) - 1 and (out is None or size == out.end):
            return
        number = len(self.strings)
        self.strings.append(string)
        self.sizes.append(sizes)
        self.anchors.append(anchor)
        self.done.append(done)
        if out is not None and size < out.end:
            old = self.strings[out.string]
            parent = here if here.children.get(old[out.start + 1]) is out else self._parent(out)
            del self.handles[self._handle(out)]
            split = Node(out.string, out.start, size)
            parent.children[old[out.start + 1]] = split
            out.start = size
            split.children[old[size + 1]] = out
            for node in (out, split):
                self.handles[self._handle(node)] = node
            here = split
        if size < len(string) - 1:
            leaf = Node(number, size, len(string) - 1)
            here.children[string[size + 1]] = leaf
            self.handles[self._handle(leaf)] = leaf

    def _parent(self, node: Node) -> Node:
        """The node at whose extent another begins: its prefix of that length is searched."""
        return self.exit_of(self.strings[node.string][: node.start + 1])[0]

    def expanded(self, there: dict[bytes, tuple]) -> list[list]:
        """A row for each depth of each edge beyond what is done: see NODES.

        there: by prefix, what is to be added there: members, the least of these, children, leaves and sum below, and the hash of ends.
        """
        out: list[list] = []
        top: dict[int, tuple] = {}  # of nodes that are through: what their first depth has, and its row
        stack = [(self.root, False)]
        while stack:
            node, seen = stack.pop()
            if not seen:
                stack.append((node, True))
                stack += [(child, False) for child in node.children.values()]
                continue
            below = [top.pop(id(child)) for child in node.children.values()]
            n, least = sum(x[0] for x in below), min((x[1] for x in below if x[1] is not None), default=None)
            leaves, saved = sum(x[2] for x in below), sum(x[3] for x in below)
            waiting = [x[4] for x in below if x[4] is not None]
            if node is self.root:
                break
            string, sizes, done, row = self.strings[node.string], self.sizes[node.string], self.done[node.string], None
            for depth in range(node.end, max(node.start, done), -1):
                more = there.get(string[depth])
                kids, ends = len(node.children) if depth == node.end else 1, None
                if more:
                    n, least = n + more[0], more[1] if least is None else min(least, more[1])
                    kids, leaves, saved, ends = kids + more[2], leaves + more[3], saved + more[4], more[5]
                leaves = leaves if kids else 1
                saved += (n - 1) * int(sizes[depth - 2]) if depth > 1 else 0
                row = [depth, string[depth], least, None, n, kids, leaves, saved, ends, string[done] if depth == done + 1 and done else None, self.anchors[node.string] if depth == 1 else None]
                for child in waiting:
                    child[3] = least
                waiting = [row]
                out.append(row)
            top[id(node)] = (n, least, leaves, saved, row if row is not None and row[0] == node.start + 1 else None)
        return out


#: up: of the first depth beyond what is done, the prefix before it; anchor: of depth 1.
NODES = "depth int, prefix binary, first long, parent long, n long, kids long, leaves long, saved long, ends string, up binary, anchor string"
_NAMES = [x.split()[0] for x in NODES.split(", ")]


def _sub_tries(rows: pd.DataFrame) -> pd.DataFrame:
    trie, there = Trie(), {}
    for r in rows.itertuples(index=False):
        string = prefixes(r.anchor, r.hashes)
        trie.insert(r.anchor, string, r.sizes, r.done)
        there[string[-1]] = (r.n, r.first, r.kids, r.leaves, r.saved, r.ends)
    return pd.DataFrame(trie.expanded(there), columns=_NAMES)


def _batch(todo: DataFrame, number: int) -> Trie:
    """A trie of some strings chosen by hash, of bounded size."""
    trie, turns = Trie(), 0
    for r in todo.orderBy(F.xxhash64("anchor", "digest", F.lit(number)), "anchor", "digest").limit(BATCH).collect():
        turns += len(r["hashes"])
        if trie.strings and turns > BATCH_TURNS:
            break
        trie.insert(r["anchor"], prefixes(r["anchor"], r["hashes"]), r["sizes"], r["done"])
    return trie


def _located(todo: DataFrame, trie: Trie) -> DataFrame:
    """todo with done (the length that is in this trie or an earlier one), here (that prefix) and way (the prefix a turn longer, null if there is none)."""
    shared = todo.sparkSession.sparkContext.broadcast(trie)  # of bounded size

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            each = [prefixes(anchor, hashes) for anchor, hashes in zip(batch["anchor"], batch["hashes"])]
            sizes = [max(done, shared.value.exit_of(string)[2]) for string, done in zip(each, batch["done"].tolist())]
            yield batch.assign(done=sizes, here=[s[n] for s, n in zip(each, sizes)], way=[s[n + 1] if n + 1 < len(s) else None for s, n in zip(each, sizes)])

    kinds = ", ".join(f"{name} {kind}" for name, kind in todo.dtypes)
    return todo.mapInPandas(found, f"{kinds}, here binary, way binary")


def nodes(todo: DataFrame) -> DataFrame:
    """All nodes (NODES) of the tries of some strings: anchor, digest, hashes, sizes, n, first, ends, kids, leaves, saved."""
    spark = todo.sparkSession
    todo, batches = todo.withColumn("done", F.lit(0)), []
    while todo is not None:
        trie = _batch(todo, len(batches))
        if not trie.strings:
            break
        placed = cut(_located(todo, trie))
        on = placed.where("way is not null")
        groups = on.groupBy("way").agg(F.sum(F.size("hashes") + 1).alias("turns"))
        most, turns = groups.agg(F.max("turns"), F.sum("turns")).first()
        todo = None
        if most is not None and most > GROUP_TURNS:
            large = cut(groups.where(F.col("turns") > GROUP_TURNS).select("way"))
            todo = on.join(large, "way", "left_semi").drop("here", "way")
            on = on.join(large, "way", "left_anti")
        bucket = F.pmod(F.xxhash64("way"), F.lit(max(1, -(-(turns or 0) // BUCKET_TURNS))))
        batches.append((trie, placed.where("way is null"), cut(on.groupBy(bucket.alias("bucket")).applyInPandas(_sub_tries, NODES))))
    everything = spark.createDataFrame([], NODES)
    for trie, ended, own in reversed(batches):
        everything = everything.unionByName(own)
        hanging = everything.where("up is not null").groupBy(F.col("up").alias("here")).agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.count("*").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.lit(None).cast("string").alias("ends"))
        whole = hanging.unionByName(ended.select("here", "n", "first", "kids", "leaves", "saved", "ends"))
        summed = whole.groupBy("here").agg(*(f(c).alias(c) for f, c in ((F.sum, "n"), (F.min, "first"), (F.sum, "kids"), (F.sum, "leaves"), (F.sum, "saved"), (F.max, "ends"))))
        # as many rows as the tries of the batches have places, at most
        there = {bytes(r["here"]): tuple(r)[1:] for r in summed.collect()}
        first = spark.createDataFrame(trie.expanded(there), NODES)
        parents = F.broadcast(first.select(F.col("prefix").alias("up"), F.col("first").alias("_parent")))
        # what hangs at an earlier batch's place waits for that
        everything = everything.join(parents, "up", "left").withColumns({"parent": F.coalesce("parent", "_parent"), "up": F.when(F.col("_parent").isNull(), F.col("up"))}).drop("_parent")
        everything = cut(everything.unionByName(first))
    return everything


def trie(messages: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 for each node."""
    conversations, turns = rebuilt(cut(ranked(messages)))
    every = cut(strings(cut(segments(conversations, turns))))
    last = every.agg(F.max("seg")).first()[0]
    out, below = [], None
    # from the deepest segments up: one round unless a conversation has over SEGMENT turns
    for seg in range(last if last is not None else 0, -1, -1):
        own = every.where(F.col("seg") == seg)
        if below is None:
            own = own.withColumns({c: F.lit(0).cast("long") for c in ("kids", "leaves", "saved")})
        else:
            ahead = below.where("depth = 1").select(F.col("anchor").alias("after"), "kids", F.when(F.col("kids") > 0, F.col("leaves")).alias("leaves"), "saved", F.col("ends").alias("_ends"))
            own = own.join(ahead, "after", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("kids", "leaves", "saved")}).withColumn("ends", F.coalesce("ends", "_ends")).drop("_ends")
        below = nodes(own.select("anchor", "digest", "hashes", "sizes", "n", "first", "ends", "kids", "leaves", "saved"))
        deeper = below if not seg else below.where("depth > 1")
        out.append(deeper.withColumn("depth", F.col("depth") - 1 + F.lit(seg).cast("long") * SEGMENT))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole.select(
        F.col("first").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256")
    )
