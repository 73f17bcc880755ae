"""Near-duplicate documents by min-max hashing.

A document's set holds its distinct shingles of five words. Under each of
``PERMUTATIONS`` random permutations both the smallest and the largest value are kept,
so half as many permutations give as many signature values; each value agrees between
two sets with probability equal to their Jaccard similarity. Bands of ``ROWS`` values
put similar documents into common buckets.

Within a bucket, members are compared with its first and last member only, which is
linear in its size. Members that this leaves in different components are compared with
each other afterwards, in blocks and by a finer sketch, so that no link is lost to the
shortcut. Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.graph import components
from medallion.llm.store import stored, text_bytes, texts
from medallion.llm.words import mix, shared, shingles, word_hashes

PERMUTATIONS = 48
ROWS = 4
BANDS = 2 * PERMUTATIONS // ROWS
PERCENT = 75
BINS = 1024
BLOCK = 1024

_RANDOM = np.random.default_rng(20)
_MULTIPLY = _RANDOM.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RANDOM.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_COLUMN = _RANDOM.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RANDOM.integers(0, 2**63, BANDS, dtype=np.uint64)
_STEP = 2048

SKETCH = "doc_id long, n_shingles long, set_key binary, buckets array<long>"


def signature(hashes: np.ndarray) -> np.ndarray:
    """Smallest values under all permutations, then the largest."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(hashes), _STEP):
        values = hashes[at : at + _STEP, None] * _MULTIPLY + _ADD
        np.minimum(low, values.min(axis=0), out=low)
        np.maximum(high, values.max(axis=0), out=high)
    return np.concatenate([low, high])


def bucket_keys(values: np.ndarray) -> np.ndarray:
    """One key per band of a signature."""
    rows = mix(values.reshape(BANDS, ROWS) * _COLUMN)
    return mix(rows.sum(axis=1, dtype=np.uint64) + _BAND).view(np.int64)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, keys, buckets = [], [], []
        for text in texts(batch.column("text")):
            found = shingles(word_hashes(text))
            values = signature(found) if len(found) else None
            counts.append(len(found))
            keys.append(None if values is None else xxhash.xxh3_128_digest(found.tobytes()))
            buckets.append(None if values is None else bucket_keys(values))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(buckets, pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "set_key", "buckets"],
        )


def sketch(docs: DataFrame) -> DataFrame:
    """Per row: set size, and of the set a 128-bit key and bucket keys (null: empty set)."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes())
    return plain.mapInArrow(_sketch_batches, SKETCH)


class _Sets:
    """Sets of the texts seen lately, by doc_id and text."""

    def __init__(self, limit: int = 2_000_000) -> None:
        self.limit, self.size, self.known = limit, 0, {}

    def of(self, doc_id: int, text: bytes) -> np.ndarray:
        key = doc_id, len(text), hash(text)
        if key not in self.known:
            if self.size > self.limit:
                self.size, self.known = 0, {}
            self.known[key] = shingles(word_hashes(text))
            self.size += len(self.known[key])
        return self.known[key]


def _confirm_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets = _Sets()
    for batch in batches:
        keep = []
        for a, b, text_a, text_b in zip(*(texts(batch.column(c)) for c in ("a", "b", "text_a", "text_b"))):
            left, right = sets.of(a, text_a), sets.of(b, text_b)
            both = shared(left, right)
            keep.append(100 * both >= PERCENT * (len(left) + len(right) - both) > 0)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def confirm(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Those ``(a, b)`` whose full sets are similar enough; ``found`` holds their texts."""
    # Merge joins at every size: texts are never broadcast, and hot documents are split.
    with_b = pairs.join(found.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
    with_a = with_b.join(found.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
    return with_a.select("a", "b", "text_a", "text_b").mapInArrow(_confirm_batches, "a long, b long")


def profile(found: np.ndarray) -> np.ndarray:
    """One byte per bin: of the smallest of the set's hashes in it, 0 where it has none."""
    least = np.full(BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, (found % np.uint64(BINS)).astype(np.int64), found)
    filled = least != np.iinfo(np.uint64).max
    return np.where(filled, (least >> np.uint64(40)) % np.uint64(255) + np.uint64(1), 0).astype(np.uint8)


def _profile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, profiles = [], []
        for text in texts(batch.column("text")):
            found = shingles(word_hashes(text))
            sizes.append(len(found))
            profiles.append(profile(found).tobytes())
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(profiles, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["rep", "size", "profile"])


def _alike(one: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which sets may be similar enough, by five standard deviations of the sketch.

    Bins sample the union without replacement, so the fewer shingles they leave out,
    the less the share of equal bins can stray from the similarity.
    """
    bins = np.count_nonzero(others | one, axis=1)
    equal = np.count_nonzero((others == one) & (one != 0), axis=1)
    union = (sizes + size) * (100 / (100 + PERCENT))
    left_out = np.maximum(1 - bins / union, 0.02)
    share = PERCENT / 100
    return equal >= share * bins - 5 * np.sqrt(share * (1 - share) * bins * left_out) - 1


def _meet(table: pa.Table) -> pa.Table:
    """Pairs of different components with like profiles, within each ``(bucket, i, j)``."""
    table = table.sort_by([("bucket", "ascending"), ("i", "ascending"), ("j", "ascending")])
    keys = [table.column(c).to_numpy() for c in ("bucket", "i", "j")]
    rep, component, block, size = (
        table.column(c).to_numpy() for c in ("rep", "component", "block", "size")
    )
    profiles = np.frombuffer(b"".join(table.column("profile").to_pylist()), np.uint8).reshape(-1, BINS)
    changed = np.zeros(len(rep), dtype=bool)
    changed[:1] = True
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    starts = np.append(np.flatnonzero(changed), len(rep))
    pairs = set()
    for start, end in zip(starts[:-1], starts[1:]):
        i, j = keys[1][start], keys[2][start]
        left = np.flatnonzero(block[start:end] == i) + start
        right = left if i == j else np.flatnonzero(block[start:end] == j) + start
        for at, x in enumerate(left):
            others = right[at + 1 :] if i == j else right
            others = others[component[others] != component[x]]
            alike = _alike(profiles[x], size[x], profiles[others], size[others])
            pairs.update((min(rep[x], rep[y]), max(rep[x], rep[y])) for y in others[alike])
    found = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": found[:, 0], "b": found[:, 1]})


def _like_pairs(apart: DataFrame) -> DataFrame:
    """``(a, b)`` of members ``(bucket, rep, component, size, profile)`` of one bucket that are
    in different components and have like profiles.

    A large bucket is cut into blocks, and each pair of blocks is compared by itself;
    small buckets share a task. Either way a task's rows are bounded.
    """
    sizes = apart.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    cut = apart.join(sizes, "bucket").withColumn("block", F.expr("pmod(xxhash64(rep), blocks)"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = cut.select("bucket", "rep", "component", "size", "profile", "block", other).select(
        "*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    dealt = stored(dealt.drop("other"), "apart")
    tasks = max(1, dealt.count() // (4 * BLOCK))
    chunk = F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(tasks))
    return dealt.groupBy(chunk.alias("chunk")).applyInArrow(_meet, "a long, b long")


def _candidate_texts(docs: DataFrame, *pairs: DataFrame) -> DataFrame:
    ids = None
    for p in pairs:
        for side in ("a", "b"):
            one = p.select(F.col(side).alias("doc_id"))
            ids = one if ids is None else ids.unionByName(one)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes())
    return plain.hint("merge").join(ids.distinct(), "doc_id", "left_semi")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs`` (``doc_id``, ``text``).

    Rows of equal sets are reduced to the smallest doc_id before anything is compared.
    Null, empty or blank texts have no set and are linked with nothing. Rows that share
    a doc_id are one node. A row without doc_id has no component and is kept, as nothing
    can name it a copy. An empty table gives an empty result. Other columns are ignored.
    """
    rows = stored(sketch(docs), "sketches")
    sets = stored(
        rows.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"), F.first("buckets").alias("buckets")),
        "sets",
    )
    members = sets.select("rep", F.explode("buckets").alias("bucket"))
    crowded = (
        members.groupBy("bucket")
        .agg(F.min("rep").alias("first"), F.max("rep").alias("last"))
        .where("first < last")
    )
    placed = stored(members.join(crowded, "bucket"), "bucket-members")
    stars = stored(
        placed.select(F.col("first").alias("a"), F.col("rep").alias("b"))
        .unionByName(placed.select(F.col("rep").alias("a"), F.col("last").alias("b")))
        .where("a < b")
        .distinct(),
        "star-pairs",
    )
    found = stored(_candidate_texts(docs, stars), "candidate-texts")
    links = stored(confirm(stars, found), "star-links")
    linked = components(links)

    # Bucket members that are not in one component yet meet each other.
    known = placed.select("bucket", "rep").join(linked.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    split = known.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    apart = known.join(split.where("low < high").select("bucket"), "bucket").join(
        found.mapInArrow(_profile_batches, "rep long, size long, profile binary").dropDuplicates(["rep"]), "rep"
    )
    met = _like_pairs(apart).distinct()
    rest = stored(met.join(stars, ["a", "b"], "left_anti"), "rest-pairs")
    more = confirm(rest, found)

    copies = rows.join(sets.select("set_key", "rep"), "set_key", "left")
    same_id = copies.where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    final = components(links.unionByName(more).unionByName(same_id))
    named = rows.select("doc_id", "n_shingles").join(
        final.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    )
    component = F.coalesce("component", "doc_id")
    return named.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that lead their group, all columns; one row per doc_id and text."""
    verdict = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(verdict.withColumnRenamed("doc_id", "dropped_id"), F.col("doc_id") == F.col("dropped_id"), "left_anti")
