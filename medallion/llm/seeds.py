"""Benchmark decontamination by spaced seeds.

A mask fixes which word positions of a window are hashed; the others may differ. Test
items and documents that agree under a mask at some position are aligned there without
gaps, and the best-scoring stretch of the alignment decides, so substituted words inside
a copied passage do not hide it.

The items are indexed in blocks of bounded size, which are broadcast one after another;
documents are read once per block and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import text_bytes, texts
from medallion.llm.words import mix

MASKS = ("11111111", "11110001111", "11011011011", "1110111000111")
SHORT = range(5, 8)  # items of so few words must occur whole
MATCHED = 12  # words, or SHARE of a shorter item
SHARE = 0.8
MISMATCH = -3
BLOCK_WORDS = 500_000

MATCHES = (
    "doc_id long, item_id long, matched long, item_words long, doc_start long, doc_end long, item_start long"
)
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_FILTER_BITS = 22
_ODD = np.random.default_rng(10).integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def tokens(text: bytes | None) -> np.ndarray:
    """Hashes of the words, lower-cased and without ASCII punctuation."""
    lower = (text or b"").decode("utf-8", "replace").lower().encode("utf-8", "replace")
    words = lower.translate(None, _PUNCTUATION).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mask_hashes(found: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every window of the mask's span, over the positions it keeps."""
    count = len(found) - len(mask) + 1
    if count <= 0:
        return found[:0]
    total = np.full(count, int(mask, 2), dtype=np.uint64)
    kept = [i for i, bit in enumerate(mask) if bit == "1"]
    for odd, i in zip(_ODD, kept):
        total += found[i : i + count] * odd
    return mix(total)


class Index:
    """Test items by the hashes of their windows."""

    def __init__(self, items: list[tuple[int | None, bytes | None]]) -> None:
        self.ids = [item for item, _ in items]
        self.words = [tokens(text) for _, text in items]
        self.masks = []
        lengths = {len(w) for w in self.words}
        short = tuple("1" * n for n in SHORT if n in lengths)
        for mask in MASKS + short:
            hashes, owners, places = [], [], []
            for at, words in enumerate(self.words):
                if mask in short and len(words) != len(mask):
                    continue
                found = mask_hashes(words, mask)
                hashes.append(found)
                owners.append(np.full(len(found), at))
                places.append(np.arange(len(found)))
            if not hashes:
                continue
            key = np.concatenate(hashes)
            order = np.argsort(key, kind="stable")
            present = np.zeros(1 << _FILTER_BITS, dtype=bool)
            present[key >> np.uint64(64 - _FILTER_BITS)] = True
            joined = np.concatenate(owners)[order], np.concatenate(places)[order]
            self.masks.append((mask, key[order], *joined, present))

    def diagonals(self, found: np.ndarray) -> set[tuple[int, int]]:
        """``(item, shift)`` wherever a window of the text has the hash of an item's window."""
        seen: set[tuple[int, int]] = set()
        for mask, key, owner, place, present in self.masks:
            hashes = mask_hashes(found, mask)
            at = np.flatnonzero(present[hashes >> np.uint64(64 - _FILTER_BITS)])
            low = np.searchsorted(key, hashes[at], "left")
            high = np.searchsorted(key, hashes[at], "right")
            for position, a, b in zip(at[low < high], low[low < high], high[low < high]):
                seen.update(zip(owner[a:b].tolist(), (position - place[a:b]).tolist()))
        return seen

    def overlap(self, found: np.ndarray, item: int, shift: int) -> tuple[int, int, int] | None:
        """``(matched, start, end)`` in item words of the best stretch, if it is long enough."""
        words = self.words[item]
        low, high = max(0, -shift), min(len(words), len(found) - shift)
        equal = words[low:high] == found[low + shift : high + shift]
        score = np.concatenate([[0], np.cumsum(np.where(equal, 1, MISMATCH))])
        floor = np.minimum.accumulate(score)
        end = int(np.argmax(score - floor))
        start = int(np.argmin(score[: end + 1]))
        matched = int(np.count_nonzero(equal[start:end]))
        whole = len(words) in SHORT
        enough = matched >= (len(words) if whole else min(MATCHED, np.ceil(SHARE * len(words))))
        if not enough or matched < SHARE * (end - start):
            return None
        return matched, low + start, low + end

    def matches(self, text: bytes | None) -> list[tuple]:
        """The best overlap with each item: item_id, matched, item words, document span, item start."""
        found = tokens(text)
        best: dict[int, tuple] = {}
        for item, shift in self.diagonals(found):
            if got := self.overlap(found, item, shift):
                matched, start, end = got
                row = (-matched, start + shift, end + shift, start)
                best[item] = min(best.get(item, row), row)
        return [
            (self.ids[i], -row[0], len(self.words[i]), *row[1:]) for i, row in sorted(best.items())
        ]


def _find(index) -> object:
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n.split()[0], pa.int64()) for n in MATCHES.split(", ")])
        for batch in source:
            ids = batch.column("doc_id").to_pylist()
            rows = [
                (doc_id, *match)
                for doc_id, text in zip(ids, texts(batch.column("text")))
                for match in index.value.matches(text)
            ]
            columns = zip(*rows) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=schema)

    return batches


def item_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int | None, bytes | None]]]:
    """The items, dealt into blocks of about ``block_words`` words, one collected at a time."""
    plain = items.select(F.col("item_id").cast("long").alias("item_id"), text_bytes())
    words = F.regexp_count(F.col("text").cast("string"), F.lit(r"\S+"))
    total = plain.agg(F.sum(words)).first()[0] or 0
    count = total // block_words + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for at in range(count):
        yield [tuple(row) for row in plain.where(block == at).distinct().collect()]


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document row and test item it overlaps, as in ``MATCHES``; clean documents have none.

    Spans count words without punctuation. Rows with null or empty text overlap
    nothing; items of fewer than five words are no evidence and match nothing. Repeated
    documents each have their rows, repeated items count once, items sharing an id each
    have their own row. An empty table gives no rows. Other columns are ignored.
    """
    context = docs.sparkSession.sparkContext
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes())
    found = [plain.mapInArrow(_find(context.broadcast(Index(b))), MATCHES) for b in item_blocks(items)]
    return reduce(DataFrame.unionByName, found)


def _clean(index) -> object:
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            keep = [not index.value.matches(text) for text in texts(batch.column("__text"))]
            yield batch.drop_columns(["__text"]).filter(pa.array(keep, pa.bool_()))

    return batches


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no test item, with all their columns."""
    context = docs.sparkSession.sparkContext
    for block in item_blocks(items):
        with_text = docs.withColumn("__text", F.col("text").cast("binary"))
        docs = with_text.mapInArrow(_clean(context.broadcast(Index(block))), docs.schema)
    return docs
