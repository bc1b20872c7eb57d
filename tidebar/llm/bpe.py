"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can be the last
one of the prefix's encoding: a token t that ends there and that stays next to
the last token of the prefix before t when the two are merged by rank. The table of these
tokens is filled from left to right; walking it back from any position gives
that prefix's encoding. So appending bytes only extends the table, and after
an edit the table is kept up to the edit.

Texts: null counts as empty and gives no tokens. Pieces are the matches of the
tokenizer's pattern, each encoded by itself; a long piece is one table, filled byte by byte, and is not
remembered. There are no ties, as a prefix has one valid last token. Rows that repeat give the
same tokens each. No rows give none; columns of any other name play no part.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pieces that a worker remembers; beyond that it starts again with an empty memory.
MEMORY = 800_000
#: The rank of what is never merged.
NEVER = 1 << 60
#: The classes of the pattern below U+0100, where re is faster than regex: letters, numbers, white space.
LETTERS, NUMBERS, SPACE = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", " \\t-\\r\\x85\\xa0"

ENCODED = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file: base64 token, blank, rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class PrefixTable:
    """The last tokens of all prefixes of one piece; append() and replace() keep it exact."""

    def __init__(self, coder: "Coder", piece: bytes = b""):
        self.coder, self.piece, self.last = coder, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.piece += more
        self.coder.extend(self.piece, self.last)

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Put new in place of piece[start:end]; prefixes up to start keep their tokens."""
        self.piece = self.piece[:start] + new + self.piece[end:]
        del self.last[start:]
        self.coder.extend(self.piece, self.last)

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the first end bytes (all, if not given)."""
        out, at = [], len(self.piece) if end is None else end
        while at:
            out.append(self.last[at - 1])
            at -= len(self.coder.bytes_of[out[-1]])
        return out[::-1]


class Coder:
    """Encodes and decodes whole texts with one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.pattern = regex.compile(pattern)
        self.narrow = re.compile(narrowed(pattern)) if narrowed(pattern) else None
        self.pairs: dict[int, bool] = {}
        self.lone: dict[int, bool] = {}
        self.spines: dict[int, tuple] = {}
        self.memory: dict[str, bytes] = {}

    def _merged(self, data: bytes, least: int = 1) -> list[bytes]:
        """Plain merging by lowest rank, leftmost first, down to so many parts at least."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least:
            rank, i = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _alone(self, token: int) -> bool:
        data = self.bytes_of[token]
        return self._merged(data) == [data]

    def _spine(self, token: int) -> tuple:
        """For both ends of a token: the tokens that are at that end one after another while it is
        merged, each with the rank of the merge that takes it up; and whether parts come before wholes."""
        if token not in self.spines:
            data = self.bytes_of[token]
            if len(data) == 1:
                self.spines[token] = ((data, NEVER),), ((data, NEVER),), True
            else:
                parts = self._merged(data, 2)
                left, right = (self.ranks.get(parts[0]), self.ranks.get(parts[-1])) if len(parts) == 2 else (None, None)
                if left is None or right is None:
                    self.spines[token] = (), (), False
                else:
                    (first, _, a), (_, end, b) = self._spine(left), self._spine(right)
                    up = lambda spine: (*spine[:-1], (spine[-1][0], token), (data, NEVER)) if spine else ()
                    self.spines[token] = up(first), up(end), a and b and left < token and right < token
        return self.spines[token]

    def _fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their bytes are merged together."""
        (_, ends, a), (starts, _, b) = self._spine(left), self._spine(right)
        if not (a and b):
            data, more = self.bytes_of[left], self.bytes_of[right]
            return self._merged(data + more) == [data, more]
        i = j = 0
        while True:
            (x, taken_x), (y, taken_y) = ends[i], starts[j]
            across = self.ranks.get(x + y, NEVER)
            if across < taken_x and across <= taken_y and across != NEVER:
                return False
            if taken_x == NEVER and taken_y == NEVER:
                return True
            if taken_x <= taken_y:
                i += 1
            else:
                j += 1

    def extend(self, piece: bytes, last: list[int]) -> None:
        """Fill last, the unique valid last token of each prefix, up to the whole piece."""
        get, pairs, lone, longest = self.ranks.get, self.pairs, self.lone, self.longest
        before = len(last) - len(self.bytes_of[last[-1]]) if last else 0
        for end in range(len(last) + 1, len(piece) + 1):
            # any order finds the same token; often it is the one before, grown by a byte, or else a short one
            for start in (before, *range(end - 1, max(end - longest, 0) - 1, -1)):
                token = get(piece[start:end])
                if token is None:
                    continue
                if start:
                    key = last[start - 1] << 32 | token
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= MEMORY:
                            pairs.clear()
                        fits = pairs[key] = self._fits(last[start - 1], token)
                else:
                    fits = lone.get(token)
                    if fits is None:
                        fits = lone[token] = self._alone(token)
                if fits:
                    last.append(token)
                    before = start
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def pieces(self, text: str) -> list[str]:
        if self.narrow and (text.isascii() or max(text) < "Ā"):
            return self.narrow.findall(text)
        return [m[0] for m in self.pattern.finditer(text)]

    def packed(self, piece: str) -> bytes:
        """The ids of a piece as little-endian unsigned 32-bit integers."""
        data = piece.encode()
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else PrefixTable(self, data).tokens()
        if len(self.memory) >= MEMORY:
            self.memory.clear()
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(data) < 64:
            self.memory[piece] = out
        return out

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        get, packed = self.memory.get, self.packed
        return b"".join([get(p) or packed(p) for p in self.pieces(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def narrowed(pattern: str) -> str | None:
    r"""The same pattern with \p{L}, \p{N} and \s spelt out for code points below U+0100."""
    classes = (("\\p{L}", LETTERS), ("\\p{N}", NUMBERS), ("\\s", SPACE))
    out = re.sub(r"\[\^([^\]]*)\]", lambda m: "[^" + _spelt(m[1], classes) + "]", pattern)
    for name, members in classes:
        out = out.replace(name, f"[{members}]")
    out = out.replace("\\S", f"[^{SPACE}]")
    return None if "\\p" in out or "(?i" in out else out


def _spelt(body: str, classes: tuple) -> str:
    for name, members in classes:
        body = body.replace(name, members)
    return body


#: A worker's coder with what it remembers, for the vocabulary it was made for.
_coder: dict = {}


def encoder(spark, ranks: dict[bytes, int], pattern: str):
    """A function from a text column to a struct of n_tokens, ids and the two digests.

    The vocabulary, of a fixed size, is the only thing that is broadcast.
    """
    shared = spark.sparkContext.broadcast((ranks, pattern))
    key = hashlib.sha256(repr((len(ranks), sorted(ranks.items()), pattern)).encode()).hexdigest()

    @F.pandas_udf(ENCODED)
    def encoded(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if _coder.get("for") != key:
            _coder.update({"for": key, "coder": Coder(*shared.value)})
        coder = _coder["coder"]
        for series in texts:
            rows = []
            for text in series:
                ids = coder.encode(text)
                rows.append((len(ids) // 4, ids, hashlib.sha256(ids).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=ENCODED.names)

    return encoded


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: Column | str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (packed) and the digests of ids and decoded bytes, one row per input row."""
    encoded = encoder(docs.sparkSession, ranks, pattern)
    out = docs.select("doc_id", F.col(text).alias("text") if isinstance(text, str) else text.alias("text"))
    return out.withColumn("encoded", encoded("text")).select("doc_id", "encoded.*")
