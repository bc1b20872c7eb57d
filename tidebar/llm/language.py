"""Language identification: a bidirectional gated recurrent network over bytes, trained by backpropagation through time.

A text is read as UTF-8 bytes in windows of WINDOW, one after another, all of them. In each a gated recurrent
unit runs forwards and another backwards, and every position gets a probability of each language from both states
at it; a text's score for a language is the mean over all its positions. The states start anew in each window,
so that a text costs in proportion to its length and windows of many texts go through the network side by side.

The languages are those of rows with a language and a letter that are not held out, and the network is fitted on
at most FIT_TEXTS of these for each language, chosen by a hash of id and text, and FIT_WINDOWS windows of FIT_WINDOW
bytes of each, spread over the whole text. Nothing but the bytes of a text goes into its prediction.

A null text, and one without a letter, is UNKNOWN with score 0, as is every text if there is nothing to learn from.
What does not fill the last window is zeros, which the network has learnt to pass and which count for nothing. Of equally
probable languages the first by name counts. Rows that repeat get the same result each, and learn as often as they stand
(up to the bound). No rows give none; columns of any other name play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
#: Rows with this remainder of crc32(doc_id) by FOLDS are held out.
FOLDS, HELD_OUT = 5, 0
#: What the network is fitted on, at most: texts of a language, windows of a text, bytes of a window.
FIT_TEXTS, FIT_WINDOWS, FIT_WINDOW = 400, 4, 48
#: Languages that are learnt, at most: those with the most rows, of equally many the first by name.
LANGUAGES = 256
#: Bytes that the states run over, and windows that go through the network at once.
WINDOW, ABREAST = 128, 2048
STATES = 6
#: Gates are straight lines of this slope around 1/2, cut off at 0 and 1: a sigmoid's cheap likeness.
SLOPE = 0.25
EPOCHS, BATCH, RATE = 8, 128, 0.01

RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


@dataclass
class Network:
    """For each direction (0 forwards, 1 backwards) of H states: bytes, what a byte adds to the update gate, the reset gate and
    the candidate (2, 3 H, 256); gates (2, 2 H, H) and candidate (2, H, H), what the state before adds; out (2, L, H) and bias (L, 1)."""

    names: list[str]
    bytes: np.ndarray
    gates: np.ndarray
    candidate: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @staticmethod
    def fresh(names: list[str], states: int = STATES, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.normal(0, 1, shape) / np.sqrt(states)).astype(np.float32)
        return Network(names, small(2, 3 * states, 256), small(2, 2 * states, states), small(2, states, states), small(2, len(names), states), np.zeros((len(names), 1), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.bytes, self.gates, self.candidate, self.out, self.bias]

    def states(self, windows: np.ndarray, way: int, keep: list | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(position, state after reading it) for all windows (n, bytes) side by side; the state (H, n) is used again.

        keep: gets, for each position, the state before, the gates and the candidate.
        """
        h = self.candidate.shape[1]
        state = np.zeros((h, len(windows)), self.bytes.dtype)
        of_bytes = self.bytes[way].copy()
        of_bytes[: 2 * h] = SLOPE * of_bytes[: 2 * h] + 0.5
        gates, candidate = SLOPE * self.gates[way], self.candidate[way]
        columns = np.ascontiguousarray(windows.T).astype(np.intp)
        positions = range(windows.shape[1]) if way == 0 else range(windows.shape[1] - 1, -1, -1)
        read = np.empty((3 * h, len(windows)), self.bytes.dtype)
        both, seen, new = np.empty((2 * h, len(windows)), self.bytes.dtype), np.empty_like(state), np.empty_like(state)
        for t in positions:
            np.take(of_bytes, columns[t], axis=1, out=read, mode="clip")
            np.matmul(gates, state, out=both)
            both += read[: 2 * h]
            np.clip(both, 0, 1, out=both)
            update, reset = both[:h], both[h:]
            np.multiply(reset, state, out=seen)
            np.matmul(candidate, seen, out=new)
            new += read[2 * h :]
            np.tanh(new, out=new)
            if keep is not None:
                keep.append((state.copy(), update.copy(), reset.copy(), new.copy()))
            state -= new
            state *= update
            state += new
            yield t, state

    def probabilities(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The sum over a window's first `length` positions of the probability of each language (L, n)."""
        ahead = np.empty((windows.shape[1], len(self.names), len(windows)), self.bytes.dtype)
        for t, state in self.states(windows, 0):
            np.matmul(self.out[0], state, out=ahead[t])
        total = np.zeros((len(self.names), len(windows)))
        short = lengths.min(initial=windows.shape[1])
        for t, state in self.states(windows, 1):
            p = ahead[t]
            p += self.out[1] @ state
            p += self.bias
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            if t >= short:
                p *= t < lengths
            total += p
        return total

    def slopes(self, windows: np.ndarray, lengths: np.ndarray, wanted: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """The mean loss over all positions, and its slope by each of weights(), by backpropagation through time."""
        n, size = windows.shape
        h, kept = self.candidate.shape[1], ([], [])
        after = [[None] * size, [None] * size]
        for way in (0, 1):
            for t, state in self.states(windows, way, kept[way]):
                after[way][t] = state.copy()
        both = [np.stack(after[way]) for way in (0, 1)]  # (size, H, n)
        p = np.matmul(self.out[0], both[0]) + np.matmul(self.out[1], both[1]) + self.bias
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        counts = (np.arange(size)[:, None] < lengths) / max(1, int(lengths.sum()))
        loss = -float((np.log(np.maximum(p[:, wanted, np.arange(n)], 1e-30)) * counts).sum())
        p[:, wanted, np.arange(n)] -= 1
        p *= counts[:, None, :]
        found = [np.zeros_like(w) for w in self.weights()]
        d_bytes, d_gates, d_candidate, d_out, d_bias = found
        d_bias += p.sum(axis=(0, 2))[:, None]
        for way in (0, 1):
            d_out[way] = np.einsum("tln,thn->lh", p, both[way], optimize=True)
            d_state = np.matmul(self.out[way].T, p)
            order = range(size) if way == 0 else range(size - 1, -1, -1)
            back = np.zeros((h, n), self.bytes.dtype)
            d_read = np.empty((size, 3 * h, n), self.bytes.dtype)
            for t, (before, update, reset, new) in zip(reversed(order), reversed(kept[way])):
                back += d_state[t]
                d_new = back * (1 - update) * (1 - new * new)
                d_candidate[way] += d_new @ (reset * before).T
                d_seen = self.candidate[way].T @ d_new
                opened = np.concatenate([update, reset])
                both_gates = np.concatenate([back * (before - new), d_seen * before]) * (SLOPE * ((opened > 0) & (opened < 1)))
                d_gates[way] += both_gates @ before.T
                d_read[t, : 2 * h], d_read[t, 2 * h :] = both_gates, d_new
                back = back * update + d_seen * reset + self.gates[way].T @ both_gates
            flat = d_read.transpose(1, 0, 2).reshape(3 * h, -1)
            at = np.ascontiguousarray(windows.T).ravel()
            for row in range(3 * h):
                d_bytes[way, row] = np.bincount(at, flat[row], minlength=256)
        return loss, found


def fit(names: list[str], windows: np.ndarray, lengths: np.ndarray, wanted: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Network:
    """A network for the languages, by steps of moving means (Adam) over windows in a fixed random order."""
    network = Network.fresh(names, seed=seed)
    rng = np.random.default_rng(seed)
    mean, square = ([np.zeros_like(w) for w in network.weights()] for _ in range(2))
    # languages count alike, however many windows each has
    share = np.bincount(wanted, minlength=len(names)).max(initial=1)
    every = np.concatenate([np.resize(np.flatnonzero(wanted == k), share) for k in range(len(names)) if (wanted == k).any()] or [np.zeros(0, np.int64)])
    step, steps = 0, epochs * -(-len(every) // BATCH)
    for _ in range(epochs):
        rng.shuffle(every)
        for at in range(0, len(every), BATCH):
            some = every[at : at + BATCH]
            _, found = network.slopes(windows[some], lengths[some], wanted[some])
            step += 1
            size = min(1.0, 1.0 / max(1e-12, float(np.sqrt(sum((g**2).sum() for g in found)))))
            rate = RATE * (1 - 0.9 * step / steps)
            for w, g, m, s in zip(network.weights(), found, mean, square):
                g *= size
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return network


# texts ----------------------------------------------------------------------------------------------------------------


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def pooled(network: Network, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, mean probability) of each text, over windows of all texts side by side."""
    data = [t.encode(errors="replace") if has_letter(t) else b"" for t in texts]
    counts = np.array([-(-len(d) // WINDOW) for d in data], dtype=np.int64)
    total = np.zeros((len(texts), len(network.names)))
    owner = np.repeat(np.arange(len(texts)), counts)
    filled = b"".join(d + b"\0" * (-len(d) % WINDOW) for d in data)
    windows = np.frombuffer(filled, np.uint8).reshape(-1, WINDOW)
    lengths = np.full(len(windows), WINDOW)
    some = counts > 0
    sizes = np.array([len(d) for d in data], dtype=np.int64)
    lengths[np.cumsum(counts)[some] - 1] = sizes[some] - (counts[some] - 1) * WINDOW
    for at in range(0, len(windows), ABREAST):
        here = slice(at, at + ABREAST)
        np.add.at(total, owner[here], network.probabilities(windows[here], lengths[here]).T)
    out = []
    for row, size in zip(total, sizes.tolist()):
        best = int(row.argmax()) if size and len(row) else -1
        # rounded, as the last digits go by which texts stand side by side
        out.append((UNKNOWN, 0.0) if best < 0 else (network.names[best], min(1.0, round(float(row[best]) / size, 6))))
    return out


_SAMPLE = T.ArrayType(T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("size", T.IntegerType())]))


@F.pandas_udf(_SAMPLE)
def _windows(texts: pd.Series) -> pd.Series:
    """FIT_WINDOWS windows spread evenly over each text, or all of it in fewer."""

    def spread(text: str) -> list[dict]:
        data = text.encode(errors="replace")
        places = np.unique(np.linspace(0, max(0, len(data) - FIT_WINDOW), FIT_WINDOWS).astype(int))
        return [{"bytes": (w := data[p : p + FIT_WINDOW]).ljust(FIT_WINDOW, b"\0"), "size": len(w)} for p in places]

    return texts.map(spread)


def train(docs: DataFrame) -> Network | None:
    """A network for the languages of docs (doc_id, text, lang), or None if no row can be learnt from."""
    key = F.xxhash64("doc_id", "text")
    named = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    most = named.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(LANGUAGES).select("lang")
    able = named.where(F.col("text").rlike(r"\p{L}")).join(F.broadcast(most), "lang", "left_semi")
    # by hash, so alike at every size: FIT_TEXTS keys of a language at most leave each task, and as many are broadcast
    by_hash = Window.partitionBy("lang").orderBy("key")
    chosen = able.select("lang", key.alias("key")).withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= FIT_TEXTS).select("lang", "key").distinct()
    sample = able.select("lang", key.alias("key"), "text").join(F.broadcast(chosen), ["lang", "key"], "left_semi")
    rows = sample.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= FIT_TEXTS).select("lang", "key", F.explode(_windows("text")).alias("w"))
    found = sorted((r["lang"], r["key"], bytes(r["bytes"]), r["size"]) for r in rows.select("lang", "key", "w.*").collect())
    if not found:
        return None
    names = sorted({r[0] for r in found})
    windows = np.frombuffer(b"".join(r[2] for r in found), np.uint8).reshape(len(found), FIT_WINDOW)
    return fit(names, windows, np.array([r[3] for r in found]), np.array([names.index(r[0]) for r in found]))


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score for each row of docs."""
    network = train(docs.select("doc_id", "text", "lang"))
    own = docs.select("doc_id", "text")
    if network is None:
        return own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(network)  # of bounded size

    @F.pandas_udf(RESULT)
    def said(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(pooled(shared.value, [t if isinstance(t, str) else None for t in texts]), columns=RESULT.names)

    return own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), said("text").alias("found")).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
