"""Exact top-k search by tiled matrix products.

Queries are dealt into blocks and candidates into shards, both of bounded size; each
pair of a block and a shard is one small task that multiplies them tile by tile and keeps
each query's best. The lists are then merged in a tree of bounded fan-in.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.store import stored

SCALE = 64
SHARD = 8192
QUERY_BLOCK = 4096
TILE = 256
FAN_IN = 64
_EXACT = 2.0**53
_LONG = 2**63 - 1


def usable() -> Column:
    """Vectors with an id and without null or non-finite components."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad


def quantized(table: pa.Table) -> np.ndarray:
    """``floor(SCALE * x)`` of every component, one row per vector of the same length."""
    column = table.column("embedding").combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).reshape(len(column), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond the exact range of doubles by whole numbers, kept within 64 bits."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if most < _EXACT:
        return a @ b.T
    whole = [[int(x) for x in row] for row in a], [[int(x) for x in row] for row in b]
    return np.array(
        [[max(-_LONG, min(_LONG, sum(x * y for x, y in zip(p, q)))) for q in whole[1]] for p in whole[0]],
        dtype=object,
    ).reshape(len(a), len(b))


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest, ties to the earlier position."""
    if len(scores) > k and scores.dtype != object:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        return np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])
    return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:k], dtype=np.int64)


def _tile(k: int) -> Callable[[pa.Table], pa.Table]:
    def block(table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending")])
        is_query = table.column("is_query").to_numpy(zero_copy_only=False)
        queries, others = table.filter(pa.array(is_query)), table.filter(pa.array(~is_query))
        query_ids, ids = queries.column("vec_id").to_numpy(), others.column("vec_id").to_numpy()
        rows: list[tuple[int, int, int]] = []
        if len(query_ids) and len(ids):
            a, b = quantized(queries), quantized(others)
            for at in range(0, len(a), TILE):
                for query_id, scores in zip(query_ids[at : at + TILE], products(a[at : at + TILE], b)):
                    real = np.flatnonzero(ids != query_id)
                    best = real[_best(scores[real], k)]
                    rows += [(int(query_id), int(ids[i]), int(scores[i])) for i in best]
        columns = zip(*rows) if rows else ([], [], [])
        return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)}).append_column(
            "shard", pa.array([table.column("shard")[0].as_py()] * len(rows), pa.int64())
        )

    return block


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Each query's ``k`` candidates with the highest integer inner products (all, if fewer).

    Both sides have vec_id and embedding. Result: query_id, rank from 1, vec_id, score;
    ties go to the smaller vec_id. A query's own rows, those of its vec_id, are no
    candidates of it. Rows without id, null vectors and vectors with null or non-finite
    components take no part; vectors meet those of their own length only. Of queries
    sharing an id the smallest vector asks; repeated candidates count each. Products
    beyond 64 bits are held at the largest number. Empty tables give an empty result.
    Other columns are ignored.
    """
    plain = [df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(usable()) for df in (queries, candidates)]
    asking = stored(plain[0].groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    known = plain[1]
    blocks = asking.count() // QUERY_BLOCK + 1
    shards = known.count() // SHARD + 1

    def dealt(df: DataFrame, by: str, parts: int, over: str, copies: int) -> DataFrame:
        own = F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(parts)).alias(by)
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias(over)
        return df.select("vec_id", "embedding", own, every, F.size("embedding").alias("dim"))

    both = dealt(asking, "block", blocks, "shard", shards).withColumn("is_query", F.lit(True)).unionByName(
        dealt(known, "shard", shards, "block", blocks).withColumn("is_query", F.lit(False))
    )
    lists = both.groupBy("block", "shard", "dim").applyInArrow(
        _tile(k), "query_id long, vec_id long, score long, shard long"
    )
    while True:
        shards = -(-shards // FAN_IN)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN))
        keys = ["query_id", "shard"] if shards > 1 else ["query_id"]
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if shards == 1:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank")
