"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source is taken a whole number of times, plus once more with the
fraction that is left. The cube method settles these fractions: within small blocks,
three documents at a time move along the one direction that keeps both the number of
documents and the number of words taken as they are, until one of them is at 0 or 1. What
blocks leave undecided (two documents at most) is dealt into new blocks, and so on, until
one block is left per source. Its flight leaves out ``LANDING`` documents, which are
settled together with what is left of the others by trying all choices.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import in_parts, stored, with_running_total

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BLOCK = 2000
LANDING = 12
SEED = 4
_EDGE = 1e-9

WORDS = "[^\\x20\\x09-\\x0D]+"


def size() -> Column:
    """Words of the whole text; null has none."""
    return F.coalesce(F.regexp_count("text", F.lit(WORDS)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target)``: targets by weight, none above ``MOST`` times its source.

    Sources take the weights in turn, by code point, null last. What sources at their
    limit can't use is shared by weight among the others, until none is above its limit.
    """
    parts = max(1, sizes.sparkSession.sparkContext.defaultParallelism)
    totals = sizes.groupBy("source").agg(F.sum(F.col("size")).alias("source_size"))
    totals = totals.withColumns({"last": F.col("source").isNull(), "one": F.lit(1)})
    placed = in_parts(totals, "sources", parts, "last", "source")
    ranked = with_running_total(placed, "one", "rank", "last", "source")
    weights = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    known = stored(
        ranked.select("source", "source_size", weights.cast("double").alias("weight"))
        .withColumn("limit", F.col("source_size") * MOST),
        "source-weights",
    )
    per_weight, capped = 0.0, -1
    while True:
        over = F.col("limit") <= per_weight * F.col("weight")
        row = known.agg(
            F.sum("source_size"), F.sum(F.when(over, F.col("limit"))),
            F.sum(F.when(~over, F.col("weight"))), F.count_if(over),
        ).first()
        if row[0] is None or not row[2] or row[3] == capped:
            break
        capped, per_weight = row[3], max(0.0, SHARE * row[0] - (row[1] or 0.0)) / row[2]
    target = F.least("limit", per_weight * F.col("weight"))
    return known.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _flight(x: np.ndarray, s: np.ndarray, draw: np.random.Generator) -> list[int]:
    """Move fractions ``x`` of documents of sizes ``s`` until at most two are left; returns those."""
    pool: list[int] = []
    for at in range(len(x)):
        if _EDGE < x[at] < 1 - _EDGE:
            pool.append(at)
        while len(pool) == 3 or len(pool) == 2 and s[pool[0]] == s[pool[1]]:
            if len(pool) == 3:
                i, j, k = (s[n] for n in pool)
                step = [k - j, i - k, j - i] if not i == j == k else [1.0, -1.0, 0.0]
            else:
                step = [1.0, -1.0]
            up = min((1 - x[n]) / d if d > 0 else -x[n] / d for n, d in zip(pool, step) if d)
            down = min(x[n] / d if d > 0 else (x[n] - 1) / d for n, d in zip(pool, step) if d)
            move = up if draw.random() * (up + down) < down else -down
            for n, d in zip(pool, step):
                x[n] = min(1.0, max(0.0, x[n] + move * d))
            pool = [n for n in pool if _EDGE < x[n] < 1 - _EDGE]
    return pool


def _land(x: np.ndarray, s: np.ndarray, left: list[int]) -> None:
    """Settle these fractions by the choice with the least error in words and, less so, in documents."""
    choices = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    words = np.abs(choices @ s[left] - x[left] @ s[left])
    count = np.abs(choices.sum(axis=1) - x[left].sum())
    x[left] = choices[np.argmin(words + count * s[left].mean() / 20)]


def _settle(last: bool) -> Callable[[pa.Table], pa.Table]:
    def block(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
        x = table.column("x").to_numpy().copy()
        s = table.column("words").to_numpy().astype(float)
        draw = np.random.default_rng([SEED, len(x), table.column("key")[0].as_py() & 0xFFFFFFFF])
        stop = max(0, len(x) - LANDING) if last else len(x)
        left = _flight(x[:stop], s[:stop], draw)
        if last:
            left += [n for n in range(stop, len(x)) if _EDGE < x[n] < 1 - _EDGE]
            if left:
                _land(x, s, left)
            left = []
        open_ = np.zeros(len(x), dtype=bool)
        open_[left] = True
        x = np.where(open_, x, np.round(x))
        kept = table.select(["doc_id", "source", "size", "copies", "words"])
        return kept.append_column("x", pa.array(x)).append_column("open", pa.array(open_))

    return block


def decisions(sizes: DataFrame) -> DataFrame:
    """How often each document is taken: ``(doc_id, source, size, copies, source_size, target, times)``.

    ``sizes`` has doc_id, source and size per row. Rows equal in all three are one unit
    of ``copies`` rows, which are taken equally often. Documents of size 0 take part
    like others. Reruns agree, whatever the partitioning.
    """
    units = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
    units = stored(units.withColumn("words", F.col("size") * F.col("copies")), "units")
    targets = stored(source_targets(units.select("source", F.col("words").alias("size"))), "targets")
    named = targets.withColumnRenamed("source", "of")
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    sharing = units.join(named, F.col("source").eqNullSafe(F.col("of")), "left")
    fraction = ratio - F.floor(ratio + _EDGE)
    open_ = stored(
        sharing.select("doc_id", "source", "size", "copies", "words", F.greatest(F.lit(0.0), fraction).alias("x")),
        "fractions",
    )
    done = []
    level = 0
    while True:
        counts = open_.groupBy(F.col("source").alias("of")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        most = counts.agg(F.max("blocks")).first()[0] or 1
        key = F.xxhash64("doc_id", "size", F.lit(SEED + level))
        dealt = open_.join(counts, F.col("source").eqNullSafe(F.col("of"))).select(
            *open_.columns, key.alias("key"), F.pmod(F.xxhash64("doc_id", F.lit(level)), F.col("blocks")).alias("block")
        )
        settled = dealt.groupBy("source", "block").applyInArrow(
            _settle(most == 1),
            "doc_id long, source string, size long, copies long, words long, x double, open boolean",
        )
        settled = stored(settled, f"settled-{level}")
        done.append(settled.where("NOT open"))
        open_ = settled.where("open").drop("open")
        level += 1
        if most == 1:
            break
    every = reduce(DataFrame.unionByName, done)
    whole = F.floor(ratio + _EDGE)
    return every.join(named, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "doc_id", "source", "size", "copies", "source_size", "target", (whole + F.col("x")).cast("long").alias("times")
    )


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size().alias("size")
    )


def mix(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, and the words taken of it.

    Null texts and texts without words have size 0. Repeated rows are taken equally
    often. A null source is a source of its own. An empty table gives an empty result.
    Other columns are ignored.
    """
    found = decisions(sized(docs))
    rows = found.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(
        "doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target",
        (F.col("size") * F.col("times")).alias("taken"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns."""
    columns = docs.columns
    found = decisions(sized(docs)).where("times > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), "times"
    ).withColumnRenamed("times", "__times")
    keyed = docs.withColumn("__words", size())
    same = (
        F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
        & F.col("source").cast("string").eqNullSafe(F.col("__source"))
        & (F.col("__words") == F.col("__size"))
    )
    taken = keyed.join(found, same)
    return taken.withColumn("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))).select(*columns)
