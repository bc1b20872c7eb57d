"""Exact top-k search by inner product, as products of tiles.

Candidates are dealt into shards and queries into blocks by a hash of their id and vector.
Each task gets one shard and one block, multiplies them in tiles, and keeps
each query's k best of its shard by partial selection; the lists are then
merged as a tree, FAN_IN shards at a time, so that no task sees more than
FAN_IN lists of k for one query.

Components are floor(SCALE * x). Vectors that are null, or hold null or
non-finite components, and rows without an id take no part. Vectors of unequal length
are compared as if the shorter ended in zeros. A query leaves out one row of
its own id and vector (itself); other rows with the same id are candidates, and a query row that repeats has its
list as often. Scores beyond a long are held at its ends. No rows give none; columns of any other name play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 64
K = 20
#: Rows in a shard of candidates and in a block of queries, about. Each shard meets each block in a task of its own, so that
#: N candidates and Q queries move N Q (1 / SHARD + 1 / BLOCK) rows: the larger both are, the less moves, and a task holds one of each.
SHARD, BLOCK = 8192, 16384
#: Queries in one tile of a product.
TILE = 256
FAN_IN = 64
#: Whole numbers up to here are exact in a double.
EXACT = 2**53


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id and q, an array of doubles that hold floor(SCALE * x), of the vectors that take part."""
    whole = F.transform(F.col(embedding), lambda x: F.lit(float(SCALE)) * x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(vec_id).cast("long").alias("id"), whole.alias("v"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine)
        # floor() of a double is a long; huge components stay doubles, which are whole anyway
        .select("id", F.transform("v", lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)).alias("q"))
    )


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows, as longs."""
    if max(1, a.shape[1]) * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < EXACT:
        return (a @ b.T).astype(np.int64)
    ends = np.iinfo(np.int64)
    x, y = (np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in (a, b))
    return np.clip(x @ y.T, ends.min, ends.max).astype(np.int64)


def _best(k: int):
    def best(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(candidates) and len(queries):
            width = max(map(len, (*candidates["q"], *queries["asked_q"])))
            ids, there = candidates["id"].to_numpy(), _matrix(candidates["q"], width)
            order = np.argsort(ids, kind="stable")  # equal scores then stand by id
            ids, there = ids[order], there[order]
            asked, own = queries["asked_id"].to_numpy(), _matrix(queries["asked_q"], width)
            take = min(k + 1, len(ids))  # one more, as the query itself may be there
            for at in range(0, len(asked), TILE):
                scores = _products(own[at : at + TILE], there)
                least = np.partition(scores, len(ids) - take, axis=1)[:, len(ids) - take]
                for i, row in enumerate(scores):
                    over = np.flatnonzero(row > least[i])
                    chosen = np.r_[over, np.flatnonzero(row == least[i])[: take - len(over)]]
                    parts.append((np.full(len(chosen), at + i), chosen, row[chosen]))
        if not parts:
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": [], "itself": []}).astype({"query_row": str, "query_id": int, "vec_id": int, "score": int, "itself": bool})
        query, place, score = (np.concatenate(x) for x in zip(*parts))
        same = (asked[query] == ids[place]) & (own[query] == there[place]).all(axis=1)
        return pd.DataFrame({"query_row": queries["asked_row"].to_numpy()[query], "query_id": asked[query], "vec_id": ids[place], "score": score, "itself": same})

    return best


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows of vectors, ties to the smaller vec_id.

    Both inputs are as quantised() gives them; queries must be rows of vectors.
    """
    sizes = vectors.agg(F.count("*").alias("n")).first()["n"], queries.agg(F.count("*").alias("n")).first()["n"]
    shards, blocks = (max(1, math.ceil(n / size)) for n, size in zip(sizes, (SHARD, BLOCK)))
    # equal query rows give equal lists: each is asked once and repeated at the end
    distinct = queries.groupBy("id", "q").agg(F.count("*").alias("times")).withColumn("row", F.sha2(F.concat_ws(",", F.col("id").cast("string"), F.array_join("q", ",")), 256))
    dealt = lambda df, n, seed: df.withColumn(seed, F.pmod(F.xxhash64("id", "q", F.lit(seed)), F.lit(n)).cast("int"))
    spread = lambda df, n, name: df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    there = spread(dealt(vectors, shards, "shard"), blocks, "block")
    asked = spread(dealt(distinct, blocks, "block"), shards, "shard")
    # new names, as a cogroup of tables with a common origin mixes up columns that are the same
    asked = asked.select(*(F.col(c).alias(f"asked_{c}") for c in ("id", "q", "row", "block", "shard")))
    lists = (
        there.groupBy("shard", "block")
        .cogroup(asked.groupBy("asked_shard", "asked_block"))
        .applyInPandas(lambda key, c, q: _best(k)(c, q).assign(shard=key[0]), "query_row string, query_id long, vec_id long, score long, itself boolean, shard int")
    )
    best = [F.col("score").desc(), F.col("vec_id")]
    while shards > 1:  # lists of k + 1, so that the query itself may still go
        shards = math.ceil(shards / FAN_IN)
        lists = lists.withColumn("shard", (F.col("shard") / FAN_IN).cast("int"))
        rank = F.row_number().over(Window.partitionBy("query_row", "shard").orderBy(*best, F.col("itself").desc()))
        lists = lists.withColumn("rank", rank).where(F.col("rank") <= k + 1).drop("rank")
    by_query = Window.partitionBy("query_row")
    own = F.row_number().over(by_query.orderBy(F.col("itself").desc(), "vec_id"))
    others = lists.withColumn("own", F.col("itself") & (own == 1)).where("not own")
    ranked = others.withColumn("rank", F.row_number().over(by_query.orderBy(*best))).where(F.col("rank") <= k)
    repeated = distinct.where("times > 1").select("row", "times")
    return (
        ranked.join(repeated, F.col("query_row") == F.col("row"), "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.coalesce("times", F.lit(1)).cast("int"))))
        .select("query_id", "rank", "vec_id", "score")
    )
