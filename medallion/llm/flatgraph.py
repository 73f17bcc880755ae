"""Near-duplicate vectors by a robust-pruned flat graph.

Equal vectors are one node. A bounded codebook deals every node to its nearest cells,
which overlap; cells are cut into shards of bounded size. Each shard builds a graph: a
node keeps neighbours that no nearer neighbour of its own makes needless, and some far
ones. A node's lists from all its shards are united. Every node then searches its shards
over the united lists, greedily from their medoids and its own place, and expands all it
meets within range. Links are verified by exact cosines; a pair that meets in several
shards counts in one of them. No pair becomes a row: shards return numbers of links
and components of their own, which are then joined.

A sample of nodes is compared with all rows; if too few of its links were found, the
work is done again with twice the overlap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.graph import components
from medallion.llm.store import stored
from medallion.llm.vectors import finite, matrix

COSINE = 0.9
OVERLAP = 4
SHARD = 4096
CODEBOOK_SAMPLE = 8192
CENTRES = 512
ROUNDS = 6
POOL = 32
NEAR = 8
FAR = 4
ALPHA = 1.2
MEDOIDS = 16
BEAM = 16
STEP = 4
TILE = 512
AUDIT = 1024
RECALL = 0.95


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


# Cells


def codebook(sample: np.ndarray, cells: int) -> list[np.ndarray]:
    """Centres of one or more levels, at most CENTRES each; further levels divide what the former leave."""
    levels, left, rest = [], max(1, cells), sample
    while True:
        count = min(left, CENTRES, len(rest))
        centres = rest[np.linspace(0, len(rest) - 1, count).astype(int)].copy()
        for _ in range(ROUNDS):
            home = _apart(rest, centres).argmin(axis=1)
            for j in np.unique(home):
                centres[j] = rest[home == j].mean(axis=0)
        levels.append(centres)
        left = -(-left // count)
        if left == 1 or count < CENTRES:
            return levels
        rest = rest - centres[_apart(rest, centres).argmin(axis=1)]


def _apart(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, less the rows' own squared lengths."""
    return (centres * centres).sum(axis=1)[None, :] - 2 * (x @ centres.T)


def nearest_cells(x: np.ndarray, levels: list[np.ndarray], overlap: int) -> np.ndarray:
    """Each row's nearest cells, one row of numbers each; a beam of partial sums over the levels."""
    codes = np.zeros((len(x), 1), dtype=np.int64)
    sums = np.zeros((len(x), 1, x.shape[1]))
    costs = np.zeros((len(x), 1))
    for centres in levels:
        count = len(centres)
        beams = codes.shape[1]
        costs = np.concatenate([costs[:, [b]] + _apart(x - sums[:, b], centres) for b in range(beams)], axis=1)
        kept = np.argsort(costs, axis=1, kind="stable")[:, :overlap]
        costs = np.take_along_axis(costs, kept, 1)
        beam, centre = kept // count, kept % count
        codes = np.take_along_axis(codes, beam, 1) * count + centre
        sums = np.take_along_axis(sums, beam[:, :, None], 1) + centres[centre]
    return codes


def _dealt(levels: list[np.ndarray], overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells: list[np.ndarray] = []
            x = unit(matrix(batch.column("embedding"))) if batch.num_rows else np.zeros((0, 1))
            for at in range(0, len(x), TILE):
                cells += list(nearest_cells(x[at : at + TILE], levels, overlap))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int64()))], names=[*batch.schema.names, "cells"])

    return task


def _sharded(placed: DataFrame, pairs: bool) -> DataFrame:
    """Nodes with their shards: per cell, its blocks of half a shard; with ``pairs``, every two of them."""
    members = placed.withColumn("cell", F.explode("cells"))
    large = members.groupBy("cell").count().where(F.col("count") > SHARD)
    blocks = large.select("cell", F.ceil(F.col("count") / (SHARD // 2)).cast("int").alias("blocks"))
    known = members.join(blocks, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    known = known.withColumn("block", F.pmod(F.xxhash64("node", F.lit(12)), F.col("blocks")).cast("int"))
    if not pairs:
        return known.select("*", F.col("block").alias("a"), F.col("block").alias("b"))
    met = known.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select("*", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b")).drop("other")


# Building


def pruned(x: np.ndarray, own: np.ndarray, pool: np.ndarray, kept: int) -> np.ndarray:
    """Each row's neighbours from its pool, the nearest first, -1 where there are fewer.

    A candidate goes when a neighbour already kept is nearer to it, by ALPHA, than the row is.
    """
    count = len(pool)
    vectors = x[pool]
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * np.einsum("nd,npd->np", x[own], vectors)))
    order = np.argsort(apart, axis=1, kind="stable")
    pool, apart = np.take_along_axis(pool, order, 1), np.take_along_axis(apart, order, 1)
    vectors = x[pool]
    alive = pool != own[:, None]
    out = np.full((count, kept), -1, dtype=np.int64)
    for slot in range(kept):
        some = alive.any(axis=1)
        if not some.any():
            break
        pick = alive.argmax(axis=1)
        out[some, slot] = pool[some, pick[some]]
        chosen = vectors[np.arange(count), pick]
        from_chosen = np.sqrt(np.maximum(0.0, 2 - 2 * np.einsum("nd,npd->np", chosen, vectors)))
        alive &= ALPHA * from_chosen > apart
        alive[np.arange(count), pick] = False
    return out


def built(x: np.ndarray) -> np.ndarray:
    """Neighbour lists of all rows, in tiles: pruned near ones and pruned far ones."""
    random = np.random.default_rng(len(x))
    lists = []
    for at in range(0, len(x), TILE):
        own = np.arange(at, min(at + TILE, len(x)))
        sims = x[own] @ x.T
        sims[np.arange(len(own)), own] = -np.inf
        size = min(POOL, len(x))
        near = np.argpartition(-sims, size - 1, axis=1)[:, :size]
        far = random.integers(0, len(x), (len(own), size))
        lists.append(np.concatenate([pruned(x, own, near, NEAR), pruned(x, own, far, FAR)], axis=1))
    return np.concatenate(lists)


def _build(table: pa.Table) -> pa.Table:
    """One shard's lists; a list names nodes, so that it can be united with others."""
    table = table.sort_by([("node", "ascending")])
    nodes = table.column("node").to_numpy()
    lists = [nodes[line[line >= 0]] for line in built(unit(matrix(table.column("embedding"))))]
    return pa.table({"node": table.column("node"), "near": pa.array(lists, pa.list_(pa.int64()))})


# Searching


def medoids(x: np.ndarray) -> np.ndarray:
    """The members most like the mean of each of a few clusters."""
    seeds = x[np.linspace(0, len(x) - 1, min(MEDOIDS, len(x))).astype(int)]
    home = (x @ seeds.T).argmax(axis=1)
    return np.array([members[(x[members] @ x[members].mean(axis=0)).argmax()] for members in (np.flatnonzero(home == j) for j in np.unique(home))])


def in_range(x: np.ndarray, own: np.ndarray, lists: np.ndarray, starts: np.ndarray, least: float) -> np.ndarray:
    """Which rows (columns) each of the rows ``own`` finds with at least this cosine.

    A greedy search keeps the best BEAM rows met and expands the best of them; everything
    met in range is expanded too, however much that is. Single precision finds the way, double
    precision decides what is in range.
    """
    count, size = len(own), len(x)
    rough = x.astype(np.float32)
    seen, found = (np.zeros((count, size), dtype=bool) for _ in range(2))
    beam = np.zeros((count, BEAM), dtype=np.int64)
    sims = np.full((count, BEAM), -np.inf, dtype=np.float32)
    waits = np.zeros((count, BEAM), dtype=bool)
    row = np.repeat(np.arange(count), len(starts) + 1)
    new = np.concatenate([np.tile(starts, (count, 1)), own[:, None]], axis=1).ravel()
    while len(row):
        fresh = ~seen[row, new]
        pairs = np.unique(row[fresh] * size + new[fresh])
        row, new = pairs // size, pairs % size
        seen[row, new] = True
        met = np.einsum("nd,nd->n", rough[own[row]], rough[new])
        near = np.flatnonzero(met >= least - 1e-3)
        near = near[np.einsum("nd,nd->n", x[own[row[near]]], x[new[near]]) >= least]
        found[row[near], new[near]] = True
        in_range_row, in_range_new = row[near], new[near]
        # The best of those just met join the beam; what is in range needs no place there.
        met[near] = -np.inf
        order = np.lexsort((-met, row))
        row, new, met = row[order], new[order], met[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        best = (rank < BEAM) & np.isfinite(met)
        at = (row[best], rank[best])
        ids, scores, open_ = np.zeros_like(beam), np.full_like(sims, -np.inf), np.zeros_like(waits)
        ids[at], scores[at], open_[at] = new[best], met[best], True
        ids, scores, open_ = (np.concatenate(two, axis=1) for two in ((beam, ids), (sims, scores), (waits, open_)))
        kept = np.argsort(-scores, axis=1, kind="stable")[:, :BEAM]
        beam, sims, waits = (np.take_along_axis(v, kept, 1) for v in (ids, scores, open_))
        turn = waits & (np.cumsum(waits, axis=1) <= STEP)
        waits &= ~turn
        who, where = np.nonzero(turn)
        who, what = np.concatenate([who, in_range_row]), np.concatenate([beam[who, where], in_range_new])
        reached = lists[what]
        row, new = np.repeat(who, reached.shape[1]), reached.ravel()
        row, new = row[new >= 0], new[new >= 0]
    found[np.arange(count), own] = False
    return found


def _components(links: np.ndarray) -> np.ndarray:
    """Per row the smallest row it is connected with."""
    label = np.arange(len(links))
    row, other = np.nonzero(links)
    linked, first = np.unique(row, return_index=True)
    while len(linked):
        better = np.minimum(label[linked], np.minimum.reduceat(label[other], first))
        better = np.minimum(better, label[better])
        if (better == label[linked]).all():
            break
        label[linked] = better
    return label


def _search(least: float) -> Callable[[pa.Table], pa.Table]:
    def task(table: pa.Table) -> pa.Table:
        table = table.sort_by([("node", "ascending")])
        nodes, copies, block = (table.column(n).to_numpy() for n in ("node", "copies", "block"))
        x, cells = unit(matrix(table.column("embedding"))), matrix(table.column("cells")).astype(np.int64)
        cell, a, b = (table.column(n)[0].as_py() for n in ("cell", "a", "b"))
        size = len(nodes)
        lines = table.column("near").combine_chunks()
        lengths = np.diff(lines.offsets.to_numpy())
        names = lines.flatten().to_numpy()
        spots = np.searchsorted(nodes, names).clip(0, size - 1)
        spots[nodes[spots] != names] = -1
        lists = np.full((size, int(lengths.max(initial=1))), -1, dtype=np.int64)
        lists[np.repeat(np.arange(size), lengths), np.concatenate([np.arange(n) for n in lengths])] = spots
        starts = medoids(x)
        links = np.concatenate([
            in_range(x, np.arange(at, min(at + TILE, size)), lists, starts, least) for at in range(0, size, TILE)
        ])
        links |= links.T
        counts = np.zeros(size, dtype=np.int64)
        for at in range(0, size, TILE):
            # A pair counts in the first cell both are in, and in the shard of its two blocks.
            here, rows = np.nonzero(links[at : at + TILE])
            here += at
            shared = np.full(len(here), np.iinfo(np.int64).max)
            for i in range(cells.shape[1]):
                for j in range(cells.shape[1]):
                    same = cells[here, i] == cells[rows, j]
                    shared[same] = np.minimum(shared[same], cells[here[same], i])
            ours = (shared == cell) & (np.minimum(block[here], block[rows]) == a) & (np.maximum(block[here], block[rows]) == b)
            counts += np.bincount(here[ours], weights=copies[rows[ours]], minlength=size).astype(np.int64)
        return pa.table({"node": nodes, "links": counts, "root": nodes[_components(links)]})

    return task


# Auditing


def audited(placed: DataFrame, counted: DataFrame, least: float) -> float:
    """The share of links found, over a bounded sample of nodes compared with all rows."""
    sample = placed.orderBy(F.xxhash64("node", F.lit(99)), "node").limit(AUDIT).select("node", "embedding", "copies")
    asked = sample.join(counted, "node", "left").collect()
    if not asked:
        return 1.0
    x = unit(np.array([r.embedding for r in asked], dtype=np.float64))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(x), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                near = unit(matrix(batch.column("embedding"))) @ x.T >= least
                total += (near * batch.column("copies").to_numpy()[:, None]).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), pa.array(total)], names=["at", "links"])

    sums = placed.select("embedding", "copies").mapInArrow(task, "at long, links long").groupBy("at").agg(F.sum("links").alias("links"))
    truth = {r.at: r.links for r in sums.collect()}
    there = sum(truth[i] - r.copies for i, r in enumerate(asked))
    return 1.0 if there <= 0 else sum(r.links or 0 for r in asked) / there


# The whole


def near_duplicates(df: DataFrame, least: float = COSINE, overlap: int = OVERLAP) -> DataFrame:
    """Each vector's number of links, and the smallest vec_id that links lead to.

    ``df`` has vec_id and embedding; other columns, whatever their names, are ignored.
    Vectors link when their cosine, in double precision, is at least ``least``. Result, one row
    per row: vec_id, n_links, component_id, kept (vec_id = component_id). Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing and are their own
    component; vectors meet those of their own length only. Equal vectors link with one
    another, repeated rows and ids as well: of a repeated id every row has its own vector's
    result. Rows without id count as vectors; a component of such rows alone has a null id and
    ``kept`` is then null. An empty table gives an empty result.
    """
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding"))
    if rows.schema["embedding"].dataType != T.ArrayType(T.FloatType()):
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    fits = finite() & F.exists("embedding", lambda v: v != 0)
    usable = rows.where(fits)
    classes = usable.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    nodes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    found = None
    for (dim,) in nodes.select(F.size("embedding")).distinct().collect():
        of_dim = _of_length(nodes.where(F.size("embedding") == dim), least, overlap)
        found = of_dim if found is None else found.unionByName(of_dim)
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if found is not None:
        linked = usable.join(found, "embedding").select("vec_id", "n_links", "component_id")
        alone = alone.where("false").unionByName(
            rows.where(~F.coalesce(fits, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        ).unionByName(linked)
    return alone.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _of_length(nodes: DataFrame, least: float, overlap: int) -> DataFrame:
    """embedding, n_links and component_id of nodes whose vectors have one length."""
    count = nodes.count()
    picked = nodes.orderBy(F.xxhash64("node", F.lit(12)), "node").limit(CODEBOOK_SAMPLE).select("embedding").collect()
    sample = unit(np.array([r.embedding for r in picked], dtype=np.float64))
    while True:
        levels = codebook(sample, -(-count * overlap // SHARD))
        most = int(np.prod([float(len(c)) for c in levels]))
        overlap = min(overlap, most)
        schema = T.StructType([*nodes.schema.fields, T.StructField("cells", T.ArrayType(T.LongType()))])
        placed = stored(nodes.mapInArrow(_dealt(levels, overlap), schema), "vector-cells")
        building = _sharded(placed.select("node", "embedding", "cells"), False)
        lists = building.groupBy("cell", "a").applyInArrow(_build, "node long, near array<long>")
        united = stored(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "vector-graph")
        searching = _sharded(placed.drop("vec_id").join(united, "node"), True)
        shards = searching.groupBy("cell", "a", "b").applyInArrow(_search(least), "node long, links long, root long")
        met = stored(shards, "vector-links")
        counted = met.groupBy("node").agg(F.sum("links").alias("links"))
        if overlap >= most or audited(placed, counted, least) >= RECALL:
            break
        overlap *= 2
    roots = components(met.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    parts = nodes.select("node", "vec_id", "copies", "embedding").join(counted, "node").join(roots, "node", "left")
    parts = stored(parts.withColumn("component", F.coalesce("component", "node")), "vector-parts")
    firsts = parts.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return parts.join(firsts, "component").select(
        "embedding", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"
    )
