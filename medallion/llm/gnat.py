"""Hard negatives by a multiway hyperplane tree over score windows.

Scores are inner products. Giving every candidate one more component, the root of the
largest squared length minus its own, makes them distances: the candidates of an anchor
with scores in a window lie in a ring around it. A node of the tree deals its vectors to
the nearest of several split points, and each split point keeps the range of its distances
to every sibling's vectors; where a range misses the ring around an anchor, by the
triangle inequality, that sibling has nothing for it. Leaves compute exact scores.

The tree's top level is dealt out by Spark: each of its subtrees is cut into shards of
bounded size, anchors visit the shards that the ranges leave, first those of their own
subtree and then, with the scores found there as the window's lower end, the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.store import stored
from medallion.llm.topk import products
from medallion.llm.vectors import finite, matrix

SCALE = 256
TOP = 32
TOP_SAMPLE = 512
SHARD = 8192
QUERY_BLOCK = 8192
FANOUT = 8
SPLIT_SAMPLE = 64
LEAF = 128
TILE = 256
_SLACK = 1e-6
_LONG = 2**63 - 1


def quantized(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """``floor(SCALE * x)`` of every component."""
    return np.floor(SCALE * matrix(column))


class Space:
    """Distances that fall as scores rise, for candidates no longer than ``longest``."""

    def __init__(self, longest: float) -> None:
        self.longest = longest
        self.slack = _SLACK * (longest + 1)

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.longest**2 - (x * x).sum(axis=1)))

    def between(self, x: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances of candidates to split points, which are candidates too."""
        squared = 2 * self.longest**2 - 2 * (x @ points.T + np.outer(self.lift(x), self.lift(points)))
        return np.sqrt(np.maximum(0.0, squared))

    def at_score(self, anchors: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Distances of anchors to candidates of these scores: one column, or one per point."""
        own = (anchors * anchors).sum(axis=1)
        return np.sqrt(np.maximum(0.0, (own if scores.ndim == 1 else own[:, None]) + self.longest**2 - 2 * scores))

    def misses(self, to_points: np.ndarray, nearest: np.ndarray, farthest: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which subtrees (columns) hold nothing in each anchor's ring (rows).

        ``least`` and ``most`` have the range of distances of point i to subtree j.
        """
        out = np.zeros((len(to_points), least.shape[1]), dtype=bool)
        for i in range(least.shape[0]):
            near = np.maximum(nearest - to_points[:, i], to_points[:, i] - farthest) - self.slack
            far = farthest + to_points[:, i] + self.slack
            out |= (most[i][None, :] < near[:, None]) | (least[i][None, :] > far[:, None])
        return out


def spread_points(x: np.ndarray, count: int, space: Space) -> np.ndarray:
    """Positions of up to ``count`` different vectors far from one another, greedily."""
    chosen = [0]
    apart = space.between(x, x[:1])[:, 0]
    while len(chosen) < min(count, len(x)):
        following = int(np.argmax(apart))
        if apart[following] <= space.slack:
            break
        chosen.append(following)
        apart = np.minimum(apart, space.between(x, x[following : following + 1])[:, 0])
    return np.array(chosen)


@dataclass
class Node:
    """A leaf's rows, or split points with their children and the ranges of distances to them."""

    rows: np.ndarray
    points: np.ndarray | None = None
    children: list[Node] | None = None
    least: np.ndarray | None = None
    most: np.ndarray | None = None


def grown(x: np.ndarray, space: Space) -> Node:
    """The tree over the rows of ``x``. Rows that no split point parts stay one leaf."""
    root = Node(np.arange(len(x)))
    waiting = [root]
    while waiting:
        node = waiting.pop()
        if len(node.rows) <= LEAF:
            continue
        sample = node.rows[np.linspace(0, len(node.rows) - 1, min(SPLIT_SAMPLE, len(node.rows))).astype(int)]
        points = x[sample[spread_points(x[sample], FANOUT, space)]]
        distances = space.between(x[node.rows], points)
        home = distances.argmin(axis=1)
        kept = np.unique(home)
        if len(kept) < 2:
            continue
        node.points = points
        node.children = [Node(node.rows[home == j]) for j in kept]
        node.least = np.array([distances[home == j].min(axis=0) for j in kept]).T
        node.most = np.array([distances[home == j].max(axis=0) for j in kept]).T
        waiting += node.children
    return root


@dataclass
class Ask:
    """The anchors of a block with their windows of scores, both ends included."""

    vectors: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    low: np.ndarray
    high: np.ndarray


def search(x: np.ndarray, ids: np.ndarray, labels: np.ndarray, space: Space, ask: Ask, k: int, same: bool) -> list[list[tuple[int, int]]]:
    """Per window its first ``k`` rows as (score, position); rows are in order of their ids."""
    most = np.abs(x).max(initial=0) * np.abs(ask.vectors).max(initial=0) * max(1, x.shape[1])
    plain = most * 2 * max(1, len(x)) < 2.0**62
    kind = np.int64 if plain else object
    nothing = -(2**63) if plain else -(2**90)
    best = np.full((len(ask.ids), k), nothing, dtype=kind)
    width = len(x)

    def leaf(rows: np.ndarray, active: np.ndarray) -> None:
        for at in range(0, len(active), TILE):
            asking = active[at : at + TILE]
            scores = products(ask.vectors[asking], x[rows]).astype(kind)
            fits = (labels[rows][None, :] == ask.labels[asking][:, None]) == same
            fits &= ids[rows][None, :] != ask.ids[asking][:, None]
            fits &= ((scores >= ask.low[asking][:, None]) & (scores <= ask.high[asking][:, None])).astype(bool)
            ranks = scores * width + (width - 1 - rows)[None, :]
            ranks[~fits] = nothing
            both = np.concatenate([best[asking], ranks], axis=1)
            both.sort(axis=1)
            best[asking] = both[:, ::-1][:, :k]

    own = ask.vectors
    floor, ceiling = ask.low.astype(float), ask.high.astype(float)
    nearest = space.at_score(own, ceiling)
    waiting = [(grown(x, space), np.arange(len(ask.ids)))]
    while waiting:
        node, active = waiting.pop()
        if not len(active):
            continue
        if node.children is None:
            leaf(node.rows, active)
            full = best[active, k - 1] != nothing
            reached = active[full]
            floor[reached] = np.maximum(floor[reached], (best[reached, k - 1] // width).astype(float))
            continue
        to_points = space.at_score(own[active], own[active] @ node.points.T)
        farthest = space.at_score(own[active], floor[active])
        out = space.misses(to_points, nearest[active], farthest, node.least, node.most)
        waiting += [(child, active[~out[:, j]]) for j, child in enumerate(node.children)]
    return [[(int(r) // width, width - 1 - int(r) % width) for r in line if r != nothing] for line in best]


FOUND = "anchor_id long, positive_no int, vec_id long, score long"


def _in_shard(space: Space, k: int, same: bool) -> Callable[[pa.Table], pa.Table]:
    """Search one shard's tree for one block of windows."""

    def task(table: pa.Table) -> pa.Table:
        asks = table.filter(table.column("is_query"))
        rows = table.filter(pa.compute.invert(table.column("is_query"))).sort_by([("vec_id", "ascending")])
        found: list[tuple[int, int, int, int]] = []
        if asks.num_rows and rows.num_rows:
            ids = rows.column("vec_id").to_numpy()
            ask = Ask(
                quantized(asks.column("embedding")), asks.column("vec_id").to_numpy(), asks.column("label").to_numpy(),
                asks.column("low").to_numpy(), asks.column("high").to_numpy(),
            )
            numbers = asks.column("positive_no").to_pylist()
            hits = search(quantized(rows.column("embedding")), ids, rows.column("label").to_numpy(), space, ask, k, same)
            for anchor, number, line in zip(ask.ids, numbers, hits):
                found += [(int(anchor), number, int(ids[at]), max(-_LONG, min(_LONG, score))) for score, at in line]
        columns = list(zip(*found)) if found else [(), (), (), ()]
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["anchor_id", "positive_no", "vec_id", "score"])

    return task


@dataclass(frozen=True)
class Top:
    """The tree's first level: split points, ranges of distances, and shards per subtree."""

    space: Space
    points: np.ndarray
    least: np.ndarray
    most: np.ndarray
    shards: dict[int, int]


ROWS = "vec_id long, label long, embedding array<double>"


def _homes(space: Space, points: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each row's nearest split point and its distances to all of them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distances = space.between(quantized(batch.column("embedding")), points) if batch.num_rows else np.zeros((0, len(points)))
            home = distances.argmin(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home), pa.array(list(distances), pa.list_(pa.float64()))],
                names=[*batch.schema.names, "subtree", "distances"],
            )

    return task


def _longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longest = 0.0
    for batch in batches:
        if batch.num_rows:
            x = quantized(batch.column("embedding"))
            longest = max(longest, float((x * x).sum(axis=1).max()))
    yield pa.RecordBatch.from_arrays([pa.array([longest])], names=["longest"])


def _top(rows: DataFrame, dim: int) -> tuple[Top, DataFrame]:
    """The first level over the rows of one length, and the rows with subtree and shard."""
    squared = rows.select("embedding").mapInArrow(_longest, "longest double").agg(F.max("longest")).first()[0]
    space = Space(float(np.sqrt(squared)))
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(13)), "vec_id", "embedding").limit(TOP_SAMPLE)
    x = np.floor(SCALE * np.array([r.embedding for r in sample.collect()]).reshape(-1, dim))
    points = x[spread_points(x, TOP, space)]
    dealt = rows.mapInArrow(_homes(space, points), f"{ROWS}, subtree int, distances array<double>")
    placed = stored(dealt, "gnat-rows")
    count = len(points)
    ranges = placed.groupBy("subtree").agg(
        F.count("*").alias("size"),
        *(F.min(F.col("distances")[i]).alias(f"least{i}") for i in range(count)),
        *(F.max(F.col("distances")[i]).alias(f"most{i}") for i in range(count)),
    ).collect()
    least, most, shards = np.full((count, count), np.inf), np.full((count, count), -np.inf), {}
    for row in ranges:
        shards[row.subtree] = -(-row["size"] // SHARD)
        least[:, row.subtree] = [row[f"least{i}"] for i in range(count)]
        most[:, row.subtree] = [row[f"most{i}"] for i in range(count)]
    return Top(space, points, least, most, shards), placed.drop("distances")


def _sharded(rows: DataFrame, top: Top) -> DataFrame:
    """Rows with their shard: subtrees larger than a shard are cut by a hash of the row."""
    of = F.create_map(*(F.lit(v) for pair in top.shards.items() for v in pair))
    cut = F.pmod(F.xxhash64("vec_id", "embedding", F.lit(14)), of[F.col("subtree")]).cast("int")
    return rows.withColumn("shard", cut)


WINDOWS = "anchor_id long, positive_no int, label long, embedding array<double>, low long, high long"


def _visits(top: Top, own: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each window once per shard that may hold something for it: of its own subtree, or of the others."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors = quantized(batch.column("embedding")) if batch.num_rows else np.zeros((0, top.points.shape[1]))
            low, high = (batch.column(n).to_numpy().astype(float) for n in ("low", "high"))
            scores = anchors @ top.points.T
            to_points = top.space.at_score(anchors, scores)
            home = top.space.between(anchors, top.points).argmin(axis=1)
            out = top.space.misses(to_points, top.space.at_score(anchors, high), top.space.at_score(anchors, low), top.least, top.most)
            at_home = np.arange(len(top.points))[None, :] == home[:, None]
            visited = at_home if own else ~at_home
            pairs = [(i, j, s) for i, j in np.argwhere(visited & ~out) for s in range(top.shards.get(int(j), 0))]
            spots, subtrees, shards = (np.array(c, dtype=np.int64) for c in (zip(*pairs) if pairs else ([], [], [])))
            taken = batch.take(pa.array(spots))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(subtrees.astype(np.int32)), pa.array(shards.astype(np.int32))],
                names=[*batch.schema.names, "subtree", "shard"],
            )

    return task


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "positive_no").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(windows: DataFrame, rows: DataFrame, top: Top, k: int, same: bool, name: str) -> DataFrame:
    """Each window's first ``k`` rows, from its own subtree and then from what else the ring reaches."""
    blocks = windows.count() // QUERY_BLOCK + 1
    block = F.pmod(F.xxhash64("anchor_id", "positive_no"), F.lit(blocks)).alias("block")

    def visited(given: DataFrame, own: bool) -> DataFrame:
        asking = given.mapInArrow(_visits(top, own), f"{WINDOWS}, subtree int, shard int").select("*", block)
        meeting = asking.select("subtree", "shard", "block").distinct()
        asks = asking.select(
            "subtree", "shard", "block", F.lit(True).alias("is_query"), F.col("anchor_id").alias("vec_id"),
            "label", "embedding", "positive_no", "low", "high",
        )
        others = rows.join(meeting, ["subtree", "shard"]).select(
            "subtree", "shard", "block", F.lit(False).alias("is_query"), "vec_id", "label", "embedding",
            F.lit(0).alias("positive_no"), F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high"),
        )
        groups = asks.unionByName(others).groupBy("subtree", "shard", "block")
        return groups.applyInArrow(_in_shard(top.space, k, same), FOUND)

    near = stored(_best(visited(windows, True), k), f"{name}-own").drop("rank")
    reached = near.groupBy("anchor_id", "positive_no").agg(F.count("*").alias("of"), F.min("score").alias("least"))
    narrowed = windows.join(reached, ["anchor_id", "positive_no"], "left").withColumn(
        "low", F.when(F.col("of") == k, F.greatest("low", "least")).otherwise(F.col("low"))
    )
    columns = [part.split()[0] for part in WINDOWS.split(", ")]
    far = visited(narrowed.select(*columns), False)
    return stored(_best(near.unionByName(far), k), name)


def _percent_windows(low: int, high: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whole scores between two percentages of the positive's: low * p <= 100 * s <= high * p."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = batch.column("positive_score").to_pylist()
            lows = [max(-_LONG, min(_LONG, -((-low * p) // 100))) for p in scores]
            highs = [max(-_LONG, min(_LONG, (high * p) // 100)) for p in scores]
            kept = pa.array([a <= b for a, b in zip(lows, highs)], pa.bool_())
            columns = [*(batch.column(n) for n in ("anchor_id", "positive_no", "label", "embedding")), pa.array(lows, pa.int64()), pa.array(highs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[p.split()[0] for p in WINDOWS.split(", ")]).filter(kept)

    return task


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """For each anchor and each of its positives, the best rows of other labels in a window of scores.

    ``df`` has vec_id, label and embedding; ``is_anchor`` is a condition on them. A score is
    the integer inner product with the anchor. An anchor's positives are the first rows of its
    label, a positive's negatives the first rows of other labels whose scores lie between
    ``low`` and ``high`` percent of its own; higher scores first, ties by smaller vec_id.
    Result: anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score.
    Rows without id or label, null or empty vectors and vectors with null or non-finite
    components take no part; vectors meet those of their own length only. Rows with the
    anchor's id are no candidates of it; of anchors sharing an id the smallest label, then
    vector, asks; other repeated rows count each. Scores beyond 64 bits are held at the largest
    number. Empty tables give an empty result. Other columns, whatever their names, are ignored.
    """
    spark = df.sparkSession
    usable = df.where(finite()).where("vec_id IS NOT NULL AND label IS NOT NULL").where(F.size("embedding") > 0)
    plain = usable.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    results = []
    for dim in [r[0] for r in plain.where("asks").select(F.size("embedding")).distinct().collect()]:
        results.append(_mined(plain.where(F.size("embedding") == dim), dim, positives, negatives, low, high))
    if not results:
        return spark.createDataFrame([], RESULT)
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found


def _mined(plain: DataFrame, dim: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    top, placed = _top(plain.drop("asks"), dim)
    rows = _sharded(placed, top)
    first = plain.where("asks").groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("own"))
    anchors = stored(first.select(F.col("vec_id").alias("anchor_id"), "own.label", "own.embedding"), "gnat-anchors")
    whole = [F.lit(-_LONG).alias("low"), F.lit(_LONG).alias("high")]
    windows = anchors.select("anchor_id", F.lit(0).alias("positive_no"), "label", "embedding", *whole)
    liked = _search(windows, rows, top, positives, True, "gnat-positives").select(
        "anchor_id", F.col("rank").alias("positive_no"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    asked = liked.drop("positive_id").join(anchors, "anchor_id")
    windows = stored(asked.mapInArrow(_percent_windows(low, high), WINDOWS), "gnat-windows")
    unliked = _search(windows, rows, top, negatives, False, "gnat-negatives")
    return unliked.join(liked, ["anchor_id", "positive_no"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
