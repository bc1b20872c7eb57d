"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]),

the sum-of-squares identity, linear in the number of features of a text. The
features are the buckets of its distinct words, statistics of its structure
and its stored length; never its id, language, source or labels.

The model is fitted on at most FIT_ROWS labelled rows, chosen by a hash of
their ids; everything else covers all rows, and whole texts, however long. An id that
is labelled both ways counts as 0; rows that repeat an id or a text are rows like any other
and get the same score, and equal scores are decided alike (THRESHOLD itself is accepted). A
null or empty text has no words and zero statistics, and gets a score like any other. Without
labelled rows the model is empty and every score is 0.5. No rows give none; columns of any
other name play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled rows that the model is fitted on, at most.
FIT_ROWS = 4000
#: Texts of the fit are in the driver as features, a bucket in 16 bits: 32 KB a text at most.
BUCKETS = 1 << 14
RANK = 6
EPOCHS = 6
RATE = 0.05
DECAY = 1e-5
#: Rows with this remainder of crc32(doc_id) by FOLDS are held out.
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

STATISTICS = (
    "log_chars", "log_words", "word_length", "letters", "upper", "digits", "marks", "space", "odd_marks", "bars",
    "words_distinct", "lines_distinct", "line_length", "ends_in_mark", "upper_words", "marked_words", "stored_chars", "empty",
)
N_STATS = len(STATISTICS)

_PACKED = np.dtype("<u2")
_FEATURES = T.StructType([T.StructField("buckets", T.BinaryType()), T.StructField("stats", T.ArrayType(T.DoubleType()))])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _share(part: int, whole: int) -> float:
    return part / whole if whole else 0.0


def features(text: str | None, n_chars: float | None) -> tuple[np.ndarray, list[float]]:
    """The distinct word buckets of a text and its statistics."""
    text = text or ""
    data = text.encode()
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    distinct = set(words)
    n = len(text)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower, digits = int(counts[65:91].sum()), int(counts[97:123].sum()), int(counts[48:58].sum())
    space = int(counts[[32, 9, 10, 13]].sum())
    wide = int(counts[128:].sum())
    marks = max(0, len(data) - upper - lower - digits - space - wide)
    odd = int(counts[[35, 36, 37, 38, 42, 33, 94, 126, 64, 61, 60, 62]].sum())
    stored = float(n_chars) if n_chars is not None and n_chars == n_chars and n_chars > 0 else 0.0
    stats = [
        np.log1p(n), np.log1p(len(words)), _share(n, len(words)) / 10, _share(upper + lower + wide, len(data)), _share(upper, upper + lower),
        _share(digits, len(data)), _share(marks, len(data)), _share(space, len(data)), _share(odd, len(data)), _share(int(counts[124]), len(words)),
        _share(len(distinct), len(words)), _share(len(set(lines)), len(lines)), np.log1p(_share(n, len(lines))),
        _share(sum(line.rstrip()[-1:] in ".!?" for line in lines), len(lines)), _share(sum(map(str.isupper, distinct)), len(distinct)),
        _share(sum(not w[-1].isalnum() for w in distinct), len(distinct)), np.log1p(stored), float(not words),
    ]
    buckets = np.unique(np.fromiter((zlib.crc32(w.encode()) & (BUCKETS - 1) for w in distinct), np.int64, len(distinct)))
    return buckets, [float(s) for s in stats]


@dataclass
class Model:
    bias: float
    linear: np.ndarray  # of buckets, then of statistics
    factors: np.ndarray  # the same rows, RANK columns
    mean: np.ndarray
    scale: np.ndarray

    def values(self, buckets: np.ndarray, stats: list[float]) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and values: each bucket 1 / sqrt(their number), statistics standardised and clipped."""
        x = np.clip((np.asarray(stats) - self.mean) / self.scale, -5, 5)
        return (
            np.r_[buckets, BUCKETS + np.arange(N_STATS)],
            np.r_[np.full(len(buckets), 1 / np.sqrt(len(buckets)) if len(buckets) else 0.0), x],
        )

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        v = self.factors[at]
        return float(self.bias + self.linear[at] @ x + 0.5 * (((x @ v) ** 2) - (x * x) @ (v * v)).sum())

    def score(self, text: str | None, n_chars: float | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(*self.values(*features(text, n_chars))), -30, 30))))


def fit(rows: list[tuple[np.ndarray | list[int], list[float], int]]) -> Model:
    """Adaptive gradient steps over the rows, in a fixed order; values are made anew at each step, as they take 8 times the room of buckets."""
    size = BUCKETS + N_STATS
    rng = np.random.default_rng(7)
    stats = np.array([r[1] for r in rows]) if rows else np.zeros((1, N_STATS))
    spread = stats.std(axis=0)
    model = Model(0.0, np.zeros(size), rng.normal(0, 0.02, (size, RANK)) if rows else np.zeros((size, RANK)), stats.mean(axis=0), np.where(spread > 1e-9, spread, 1.0))
    g_bias, g_linear, g_factors = 1e-2, np.full(size, 1e-2), np.full((size, RANK), 1e-2)
    kept = [(np.asarray(b, dtype=_PACKED), s, y) for b, s, y in rows]
    for _ in range(EPOCHS if rows else 0):
        for i in rng.permutation(len(kept)):
            buckets, own, y = kept[i]
            at, x = model.values(buckets, own)
            v = model.factors[at]
            sums = x @ v
            p = 1 / (1 + np.exp(-np.clip(model.bias + model.linear[at] @ x + 0.5 * (sums**2 - (x * x) @ (v * v)).sum(), -30, 30)))
            slope = p - y
            g_bias += slope**2
            model.bias -= RATE * slope / np.sqrt(g_bias)
            step = slope * x + DECAY * model.linear[at]
            g_linear[at] += step**2
            model.linear[at] -= RATE * step / np.sqrt(g_linear[at])
            step = slope * (x[:, None] * sums - v * (x * x)[:, None]) + DECAY * v
            g_factors[at] += step**2
            model.factors[at] = v - RATE * step / np.sqrt(g_factors[at])
    return model


@F.pandas_udf(_FEATURES)
def _featured(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, chars in batches:
        found = [features(t, c) for t, c in zip(texts, chars)]
        yield pd.DataFrame({"buckets": [b.astype(_PACKED).tobytes() for b, _ in found], "stats": [s for _, s in found]})


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """A model of labels.quality, from at most so many labelled rows of docs that are not held out."""
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # chosen by hash, so alike at every size; `rows` ids at most are broadcast
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select("doc_id", "text", F.col("n_chars").cast("double").alias("n_chars")).join(F.broadcast(chosen), "doc_id")
    # features first, 32 KB a row at most: no task holds more than so many rows of these, however long the texts
    featured = sample.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), _featured("text", "n_chars").alias("f"), "quality")
    found = featured.orderBy("key", "doc_id").limit(rows).select("doc_id", "f.*", "quality")
    return fit([(np.frombuffer(r["buckets"], _PACKED), r["stats"], r["quality"]) for r in sorted(found.collect(), key=lambda r: (r["doc_id"], r["buckets"]))])


def scorer(spark, model: Model):
    """A function from columns text and n_chars to the score; the model, of a fixed size, is broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, chars in batches:
            yield pd.Series([shared.value.score(t, c) for t, c in zip(texts, chars)], dtype=float)

    return lambda text, n_chars: score(F.col(text) if isinstance(text, str) else text, (F.col(n_chars) if isinstance(n_chars, str) else n_chars).cast("double"))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs."""
    score = scorer(docs.sparkSession, train(docs, labels))
    return (
        docs.select("doc_id", score("text", "n_chars").alias("score"))
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs with a score of THRESHOLD or more, with their own columns."""
    score = scorer(docs.sparkSession, train(docs, labels))
    return docs.where(score("text", "n_chars") >= THRESHOLD)
