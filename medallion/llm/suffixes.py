"""Removal of repeated byte strings across documents, by suffix intervals.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document of
smaller id. Which strings are common is read from a Burrows-Wheeler transform: breadth
first, intervals of suffixes are extended backwards by one symbol, which derives common
prefixes by increasing length, and the search stops at ``LENGTH``; suffixes no boundary
has come between by then begin with the same string.

One transform of the whole corpus would be one task, so equal strings are brought
together first. Every window of ``LENGTH`` bytes chooses an anchor inside it, the ``GRAM``
bytes of least hash, which depends on nothing outside the window. Anchors found in one
document only can't lie in a common string. Around the others, the windows that choose
an anchor form a segment, and segments that may share a window meet, by their anchor, in
one of many transforms of bounded size. Around an anchor that very many
documents have, segments are cut into single windows, which meet by all their bytes.

Texts are dealt into parts. A part names each anchor and each segment once, whatever the
number of its documents that have it, in lists by the bucket or block they go to; so
the rows that travel are few and long, and a string that all documents share arrives
once from each part. Texts are cut and segments compared in rounds, each stored before
the next, and working tables go when nothing reads them any more.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import discard, stored, texts
from medallion.llm.words import mix

LENGTH = 50
GRAM = 24
WINDOW = LENGTH - GRAM + 1
PART_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20  # of text, whose anchors fill a bucket
BLOCK_BYTES = 1 << 20
MEETING_BYTES = BLOCK_BYTES >> 5  # of windows that may meet around one anchor
SEGMENT_BYTES = 2 * (LENGTH + WINDOW // 2)  # of the segments around a part's anchor, about
ROUNDS = 4  # in which texts are cut and segments compared; only one round's are shuffled at a time
_PIECE = 1 << 16
_SLICE = 1 << 19  # windows whose owners are compared at once
SEED = 7  # symbols by which intervals are first told apart
_PLACE = np.uint64((1 << 20) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)


def _pieces(text: bytes) -> Iterator[tuple[int, bytes]]:
    """Pieces of a text that together have each of its windows once."""
    for at in range(0, max(0, len(text) - LENGTH + 1), _PIECE):
        yield at, text[at : at + _PIECE + LENGTH - 1]


def _joined(values: Iterable[tuple[int, bytes]]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of numbered texts, short ones several at a time: ``(bytes, ends, number, place)`` of the pieces in them."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def joined() -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        number, at, pieces = zip(*held)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        return b"".join(pieces), ends, np.array(number), np.array(at)

    for number, text in values:
        for at, piece in _pieces(text):
            held.append((number, at, piece))
            size += len(piece)
            if size >= _PIECE:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def packed(piece: bytes) -> np.ndarray:
    """The eight bytes from each place on as one number."""
    data, words = piece + bytes(15), np.empty(len(piece), np.uint64)
    for at in range(8):
        every = words[at::8]
        every[:] = np.frombuffer(data, "<u8", len(every), at)
    return words


def string_hashes(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the strings of this length that start at these places."""
    hashes = np.zeros(len(at), dtype=np.uint64)
    for step in [*range(0, length - 7, 8), length - 8]:
        hashes = mix(hashes * _ODD + words[at + step])
    return hashes.view(np.int64)


def anchors(words: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first, place, hash)`` of each run of windows with the same anchor.

    If pieces are joined that end at ``ends``, windows across an end are one run with the place -1.
    """
    runs = len(words) - GRAM + 1
    hashes, spare = words[:runs].copy(), np.empty(runs, np.uint64)
    for at in [*range(8, GRAM, 8), GRAM]:
        hashes ^= np.right_shift(hashes, _HALF, out=spare)
        hashes *= _ODD
        if at < GRAM:
            hashes += words[at : at + runs]
    hashes ^= np.right_shift(hashes, _HALF, out=spare)
    least = np.bitwise_and(hashes, ~_PLACE, out=spare)
    least |= np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span < WINDOW:
        step = min(span, WINDOW - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    place = (least & _PLACE).astype(np.int64)
    if ends is not None and len(ends) > 1:
        place[(ends[:-1, None] - np.arange(1, LENGTH)).ravel()] = -1
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    place = place[first]
    return first, place, hashes[place].view(np.int64)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, starts)``: positions in order of their key, and where each key begins there."""
    order = np.argsort(keys)
    ranked = keys[order]
    return order, np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(keys) else np.zeros(0, np.int64)


def _lists(column: pa.ChunkedArray) -> np.ndarray:
    """The values of a column of lists, one after another."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count, one after another."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))


def _of_groups(values: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    return np.split(values, starts[1:])


def _ints(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int32)


ANCHORS = "bucket int, part int, hashes array<long>, lows array<long>, highs array<long>, documents array<int>"


def _anchor_batches(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each part's anchors, by bucket: the least and largest document that has them, and how many."""

    def named(part: int, pieces: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, ords = (np.concatenate(v) for v in zip(*pieces))
        order, starts = _groups(hashes)
        low, high = np.minimum.reduceat(ords[order], starts), np.maximum.reduceat(ords[order], starts)
        count = np.diff(np.append(starts, len(order))).astype(np.int32)
        hashes = hashes[order][starts]
        bucket = hashes.view(np.uint64) % np.uint64(buckets)
        by, cuts = _groups(bucket)
        numbers = bucket[by][cuts].astype(np.int32)
        lists = [
            pa.array(_of_groups(v[by], cuts), pa.list_(kind))
            for v, kind in ((hashes, pa.int64()), (low, pa.int64()), (high, pa.int64()), (count, pa.int32()))
        ]
        columns = [pa.array(numbers), pa.array(np.full(len(numbers), part, np.int32)), *lists]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ANCHORS.split(", ")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            parts, ords = batch.column("part").to_numpy(), batch.column("ord").to_numpy()
            for part in np.unique(parts).tolist():
                rows = np.flatnonzero(parts == part)
                values = zip(rows.tolist(), texts(batch.column("text").take(pa.array(rows))))
                for piece, ends, number, _ in _joined(values):
                    first, place, hashes = anchors(packed(piece), ends)
                    inside = place >= 0
                    hashes, row = hashes[inside], number[np.searchsorted(ends, first[inside], "right")]
                    # Once a document; the sum tells pairs apart as well as a hash does.
                    order, once = _groups(hashes.view(np.uint64) + mix(row.astype(np.uint64)))
                    at = order[once]
                    found.setdefault(part, []).append((hashes[at], ords[row[at]]))
            # A part's rows lie together, so those before the last are done.
            for part in [p for p in found if p not in parts[-1:]]:
                yield named(part, found.pop(part))
        for part, pieces in found.items():
            yield named(part, pieces)

    return task


SHARED = "part int, hashes array<long>, crowded array<long>"


def _shared_anchors(crowd: int) -> Callable[[pa.Table], pa.Table]:
    """Back to each part, its anchors that more than one document has, and which of them more than ``crowd``."""

    def task(table: pa.Table) -> pa.Table:
        hashes, low, high, count = (_lists(table.column(c)) for c in ("hashes", "lows", "highs", "documents"))
        order, starts = _groups(hashes)
        shared = np.minimum.reduceat(low[order], starts) < np.maximum.reduceat(high[order], starts)
        crowded = shared & (np.add.reduceat(count[order].astype(np.int64), starts) > crowd)
        sizes = np.diff(np.append(starts, len(order)))
        is_shared, is_crowded = np.empty(len(order), bool), np.empty(len(order), bool)
        is_shared[order], is_crowded[order] = np.repeat(shared, sizes), np.repeat(crowded, sizes)
        ends = np.cumsum(pc.list_value_length(table.column("hashes")).to_numpy())
        lists = [
            pa.array([h[k] for h, k in zip(np.split(hashes, ends[:-1]), np.split(kept, ends[:-1]))], pa.list_(pa.int64()))
            for kept in (is_shared, is_crowded)
        ]
        return pa.table([table.column("part"), *lists], names=["part", "hashes", "crowded"])

    return task


SEGMENTS = (
    "part int, block int, segments binary, ids array<int>, documents array<int>, starts array<int>, "
    "windows array<int>, cut array<int>, cells array<int>, ords array<long>, text_keys array<long>"
)
PLACES = -1  # the block of the row that says where a part's runs lie
CROWDED = 0  # the key of runs whose windows meet one by one


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    found = np.zeros(len(values), dtype=bool)
    if len(known):
        order = np.argsort(values)
        ranked = values[order]
        found[order] = known[np.minimum(np.searchsorted(known, ranked), len(known) - 1)] == ranked
    return found


def segments_of(
    piece: bytes, known: np.ndarray, crowded: np.ndarray, ends: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first, count, key)``: runs of windows around shared anchors, and where their equals meet.

    A run is one segment, so its bytes are named once for all of its windows. It meets
    others by its anchor, which no more documents have than may meet; windows around a
    crowded anchor meet one by one.
    """
    first, place, hashes = anchors(packed(piece), ends)
    after = np.append(first[1:], len(piece) - LENGTH + 1)
    wide = np.flatnonzero((place >= 0) & _is_in(hashes, known))
    key = hashes[wide]
    return first[wide], (after - first)[wide], np.where(_is_in(key, crowded), CROWDED, key)


def windows_of(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """``(cell, key, content)``: the number of each window of these runs among their different ones, and those."""
    buffer = b"".join(runs)
    lengths = np.fromiter(map(len, runs), np.int64, len(runs))
    count = lengths - LENGTH + 1
    at = _ranges(np.cumsum(lengths) - lengths, count)
    known: dict[bytes, int] = {}
    cell = np.array([known.setdefault(buffer[i : i + LENGTH], len(known)) for i in at.tolist()], np.int64)
    one = np.empty(len(known), np.int64)
    one[cell] = at
    return cell, string_hashes(packed(buffer), one, LENGTH), list(known)


def pack_segments(ids: np.ndarray, owners: np.ndarray, keys: np.ndarray, content: list[bytes]) -> bytes:
    """Segments in one zstandard frame: how many, their keys, owners, numbers and lengths, and their bytes."""
    lengths = np.fromiter(map(len, content), np.int32, len(content))
    columns = (np.array([len(content)]), keys, owners, _ints(ids), lengths)
    return zstandard.compress(b"".join([*(c.tobytes() for c in columns), *content]), 1)


def unpack_segments(frame: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    data = zstandard.decompress(frame)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    keys, owners = (np.frombuffer(data, np.int64, n, at) for at in (8, 8 + 8 * n))
    ids, lengths = (np.frombuffer(data, np.int32, n, at) for at in (8 + 16 * n, 8 + 20 * n))
    ends = (8 + 24 * n + np.cumsum(lengths, dtype=np.int64)).tolist()
    return ids, owners, keys, [data[i:j] for i, j in zip([8 + 24 * n, *ends], ends)]


def _segments(blocks: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A part's different segments, by block, with their smallest document; and where they lie."""

    def task(table: pa.Table, shared: pa.Table) -> pa.Table:
        known, crowded = (np.unique(_lists(shared.column(c))) for c in ("hashes", "crowded"))
        runs: dict[bytes, int] = {}  # equal runs have one key
        found: list[tuple[np.ndarray, ...]] = []
        ords = table.column("ord").to_numpy()
        for piece, ends, number, at in _joined(enumerate(v for chunk in table.column("text").chunks for v in texts(chunk))):
            low, count, key = segments_of(piece, known, crowded, ends)
            of = np.searchsorted(ends, low, "right")
            start = low - np.append(0, ends[:-1])[of] + at[of]
            own = [runs.setdefault(piece[i:j], len(runs)) for i, j in zip(low.tolist(), (low + count + LENGTH - 1).tolist())]
            found.append((*map(_ints, (np.array(own, np.int64), number[of], start)), key))
        run, document, start, key = (np.concatenate(v) for v in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
        owners = np.full(len(runs), 2**63 - 1)
        np.minimum.at(owners, run, ords[document])
        keys = np.zeros(len(runs), np.int64)
        keys[run] = key
        content = list(runs)
        windows = np.fromiter(map(len, content), np.int64, len(content)) - LENGTH + 1
        cut, whole = np.flatnonzero(keys == CROWDED), np.flatnonzero(keys != CROWDED)
        cells, cell_keys, more = windows_of([content[i] for i in cut.tolist()])
        # Whole runs are segments under their own numbers, windows under those that follow.
        content += more
        keys = np.concatenate([keys, cell_keys])
        owners = np.concatenate([owners, np.full(len(more), 2**63 - 1)])
        cells += len(runs)
        np.minimum.at(owners, cells, np.repeat(owners[cut], windows[cut]))
        given = np.concatenate([whole, np.arange(len(runs), len(content))])
        to = mix(keys[given].view(np.uint64)) % np.uint64(blocks)
        order, starts = _groups(to)
        names = [c.split()[0] for c in SEGMENTS.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.binary(), *[pa.list_(pa.int32())] * 6, *[pa.list_(pa.int64())] * 2]
        part = table.column("part")[0].as_py()
        rows = [
            (part, int(n), pack_segments(at, owners[at], keys[at], [content[i] for i in at.tolist()]), *(None,) * 8)
            for n, at in zip(to[order][starts], _of_groups(given[order], starts) if len(order) else [])
        ]
        lying = [_ints(v) for v in (run, document, start, windows, cut, cells)]
        rows.append((part, PLACES, None, *lying, ords, table.column("text_key").to_numpy()))
        return pa.table([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    return task


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rotations in order of at least their first ``LENGTH + 1`` symbols, by doubling, and where their first ``SEED`` change."""
    # Nine bits hold a symbol, so the first ranks are of as many as fit a number.
    key, span = symbols.astype(np.int64), 1
    while span < SEED:
        key = (key << 9) | np.roll(symbols, -span)
        span += 1
    seeds = None
    while True:
        order = np.argsort(key)
        if span > LENGTH:
            return order, seeds
        ranked = key[order]
        new = np.append(True, ranked[1:] != ranked[:-1])
        seeds = new if seeds is None else seeds
        ranks = np.cumsum(new)
        rank = np.empty_like(key)
        rank[order] = ranks
        key = rank * (int(ranks[-1]) + 1) + np.roll(rank, -span)
        span *= 2


def boundaries(symbols: np.ndarray, order: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Whether each row's common prefix with the row before is shorter than ``LENGTH``.

    All intervals of one length, at first those of ``SEED`` symbols, are extended backwards
    at once. Rows with the same symbol before them map to rows in the same order, so an
    interval's extensions are its rows by that symbol; an extension's end is a boundary,
    and it is pursued only if no shorter common prefix has set that boundary before.
    """
    n = len(symbols)
    bwt = symbols[order - 1]
    to = np.empty(n, dtype=np.int64)
    to[np.argsort(bwt, kind="stable")] = np.arange(n)
    cut = np.append(seeds, True)
    low = np.flatnonzero(seeds)
    high = np.append(low[1:], n)
    for _ in range(SEED, LENGTH):
        sizes = high - low
        owner = np.repeat(np.arange(len(low)), sizes)
        rows = _ranges(low, sizes)
        before = bwt[rows]
        by = np.argsort(before, kind="stable")
        before, owner = before[by], owner[by]
        starts = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (before[1:] != before[:-1])))
        low = to[rows[by[starts]]]
        high = low + np.diff(np.append(starts, len(rows)))
        fresh = ~cut[high]
        low, high = low[fresh], high[fresh]
        cut[high] = True
        if not len(low):
            break
    cut[0] = True
    return cut[:n]


def _least_owners(segments: list[bytes], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each segment, one after another, the smallest owner; and each segment's number of windows."""
    lengths = np.fromiter(map(len, segments), np.int64, len(segments))
    ends = np.cumsum(lengths + 1)
    symbols = np.zeros(int(ends[-1]), dtype=np.int16)
    inside = np.ones(len(symbols), dtype=bool)
    inside[ends - 1] = False
    symbols[inside] = np.frombuffer(b"".join(segments), np.uint8).astype(np.int16) + 1
    order, seeds = suffix_order(symbols)
    new = boundaries(symbols, order, seeds)
    segment = np.repeat(np.arange(len(segments)), lengths + 1)
    least = np.minimum.reduceat(owners[segment[order]], np.flatnonzero(new))
    found = np.empty(len(symbols), dtype=np.int64)
    found[order] = least[np.cumsum(new) - 1]
    count = lengths - LENGTH + 1
    return found[_ranges(ends - lengths - 1, count)], count


def smallest_owners(segments: list[bytes], owners: np.ndarray) -> list[np.ndarray]:
    """For each window of each segment, the smallest owner of any segment that has it."""
    found, count = _least_owners(segments, owners)
    return np.split(found, np.cumsum(count)[:-1])


def _transform(table: pa.Table) -> pa.Table:
    found, count = _least_owners(table.column("segment").to_pylist(), table.column("owner").to_numpy())
    offsets = pa.array(np.append(0, np.cumsum(count)), pa.int32())
    return pa.table({"owners": pa.ListArray.from_arrays(offsets, pa.array(found))})


OWNERS = "part int, ids array<int>, owners array<long>"


def _in_block(transform: Callable[[pa.Table], pa.Table], block_bytes: int) -> Callable[[pa.Table], pa.Table]:
    """For each window of each part's segments, the smallest document of all that have it."""

    def task(table: pa.Table) -> pa.Table:
        distinct: dict[bytes, int] = {}
        ids, known_to, met_at, of = [], [], [], []  # by part
        for frame in (f for chunk in table.column("segments").chunks for f in texts(chunk)):
            own, owners, keys, contents = unpack_segments(frame)
            ids.append(own)
            known_to.append(owners)
            met_at.append(keys)
            of.append(np.array([distinct.setdefault(s, len(distinct)) for s in contents], dtype=np.int64))
        least, key = np.full(len(distinct), 2**63 - 1), np.zeros(len(distinct), np.int64)
        np.minimum.at(least, np.concatenate(of), np.concatenate(known_to))
        key[np.concatenate(of)] = np.concatenate(met_at)
        held = list(distinct)
        lengths = np.fromiter(map(len, held), np.int64, len(held))
        windows = lengths - LENGTH + 1
        begins = np.cumsum(windows) - windows
        # Alone at its meeting place, a segment shares nothing.
        found = np.repeat(least, windows)
        order, starts = _groups(key)
        sizes = np.diff(np.append(starts, len(order)))
        meeting = order[np.repeat(sizes > 1, sizes)]
        bounds = np.cumsum(sizes[sizes > 1])
        filled = np.cumsum(lengths[meeting])[bounds - 1]
        done, at = 0, 0
        while done < len(bounds):
            # At least one meeting place; more as long as they fit.
            size = filled[done - 1] if done else 0
            done = max(done + 1, int(np.searchsorted(filled, size + block_bytes, "right")))
            of_these = meeting[at : bounds[done - 1]]
            at = int(bounds[done - 1])
            given = pa.table({"segment": pa.array([held[i] for i in of_these.tolist()], pa.binary()), "owner": least[of_these]})
            found[_ranges(begins[of_these], windows[of_these])] = _lists(transform(given).column("owners"))
        answers = [found[_ranges(begins[which], windows[which])] for which in of]
        lists = [pa.array(ids, pa.list_(pa.int32())), pa.array(answers, pa.list_(pa.int64()))]
        return pa.table([table.column("part"), *lists], names=["part", "ids", "owners"])

    return task


SPANS = "ord long, text_key long, start long, end long"


def _spans(places: pa.Table, answers: pa.Table) -> pa.Table:
    """A part's runs of windows that a smaller document has too."""
    run, document, start, windows, cut, cells = (
        _lists(places.column(c)).astype(np.int64) for c in ("ids", "documents", "starts", "windows", "cut", "cells")
    )
    ords, text_keys = (_lists(places.column(c)) for c in ("ords", "text_keys"))
    names = ["ord", "text_key", "start", "end"]
    if not len(run):
        return pa.table([pa.array([], pa.int64())] * 4, names=names)
    ids, owners = (_lists(answers.column(c)) for c in ("ids", "owners"))
    count = np.ones(max(len(windows), int(ids.max()) + 1), dtype=np.int64)
    count[: len(windows)] = windows
    places_of = np.zeros(len(count), dtype=np.int64)
    places_of[ids] = np.cumsum(count[ids]) - count[ids]
    begins = np.cumsum(windows) - windows
    least = _ranges(places_of[: len(windows)], windows)
    least[_ranges(begins[cut], windows[cut])] = places_of[cells]
    least = owners[least]
    found = []
    reach = np.cumsum(windows[run])
    low = 0
    # Runs lie in order of document and place.
    while low < len(run):
        high = max(low + 1, int(np.searchsorted(reach, (reach[low - 1] if low else 0) + _SLICE, "right")))
        some, sizes = run[low:high], windows[run[low:high]]
        of = np.repeat(document[low:high], sizes)
        taken = np.flatnonzero(least[_ranges(begins[some], sizes)] < ords[of])
        found.append(_merged(of[taken], *[_ranges(start[low:high], sizes)[taken]] * 2))
        low = high
    of, first, last = _merged(*(np.concatenate(v) for v in zip(*found)))
    return pa.table([pa.array(c, pa.int64()) for c in (ords[of], text_keys[of], first, last + LENGTH)], names=names)


def _merged(of: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs in order of their document, joined where the bytes of one reach the next."""
    if not len(of):
        return of, first, last
    new = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (first[1:] > last[:-1] + LENGTH)))
    return of[new], first[new], last[np.append(new[1:], len(of)) - 1]


def _order() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("ord")


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.union, frames)


def repeated_spans(docs: DataFrame, block_bytes: int = BLOCK_BYTES, meeting_bytes: int = MEETING_BYTES) -> DataFrame:
    """``(ord, text_key, start, end)``: the byte runs of each text that a smaller document has too."""
    plain = docs.select(_order(), F.col("text").cast("binary").alias("text")).where(F.octet_length("text") >= LENGTH)
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(total // PART_BYTES) + 1
    part = F.pmod(F.xxhash64("ord", "text_key", F.lit(6)), F.lit(parts)).cast("int")
    keyed = plain.withColumn("text_key", F.xxhash64("text")).withColumn("part", part)
    # A part is one task's and stored in one place, so that it names an anchor once.
    single = keyed.repartitionById(parts, "part").groupBy("part", "ord", "text_key").agg(F.first("text").alias("text"))
    dealt = stored(single, "texts")
    named = dealt.select("part", "ord", "text").mapInArrow(_anchor_batches(int(total // BUCKET_BYTES) + 1), ANCHORS)
    shared = stored(
        named.groupBy("bucket").applyInArrow(_shared_anchors(meeting_bytes // LENGTH), SHARED), "shared-anchors"
    )
    many = shared.agg(F.sum(F.size("hashes"))).first()[0] or 0
    blocks = int(many * SEGMENT_BYTES // block_bytes) + 1
    rounds = min(ROUNDS, parts)

    def in_round(df: DataFrame, number: str, k: int) -> DataFrame:
        return df.where(F.pmod(number, F.lit(rounds)) == k).groupBy(number)

    def cut(k: int) -> DataFrame:
        return in_round(dealt, "part", k).cogroup(in_round(shared, "part", k)).applyInArrow(_segments(blocks), SEGMENTS)

    segments = _union(stored(cut(k), "segments") for k in range(rounds))
    discard(dealt, shared)
    compared = segments.where(F.col("block") != PLACES).select("block", "part", "segments")

    def compare(k: int) -> DataFrame:
        return in_round(compared, "block", k).applyInArrow(_in_block(_transform, block_bytes), OWNERS)

    answers = _union(stored(compare(k), "owners") for k in range(rounds))
    places = segments.where(F.col("block") == PLACES).select("part", "ids", "documents", "starts", "windows", "cut", "cells", "ords", "text_keys")
    spans = stored(places.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_spans, SPANS), "spans")
    discard(segments, answers)
    return spans


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text binary"


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), batch.column("spans")):
            kept, at, removed, runs, reach = [], 0, 0, 0, -1
            for span in sorted((s["start"], s["end"]) for s in spans.as_py() or []):
                start, end = max(span[0], at), span[1]
                if span[0] > reach:
                    runs += 1
                if end > start:
                    kept.append(text[at:start])
                    removed += end - start
                    at = end
                reach = max(reach, span[1])
            left = b"".join([*kept, text[at:]])
            rows.append((doc_id, len(text), removed, runs, hashlib.sha256(left).hexdigest(), left))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        names = [c.split()[0] for c in RESULT.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, bytes, removed bytes and runs, a digest of what is
    left, and what is left.

    Null texts are empty; texts shorter than ``LENGTH`` lose nothing. Rows without doc_id
    come after all others and lose what others have. Rows of one id don't
    remove from each other. An empty table gives an empty result. Other columns are
    ignored. A document is one value and held by one task.
    """
    spans = repeated_spans(docs).distinct().groupBy("ord", "text_key").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _order(),
        F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b"").cast("binary")).alias("text"),
    )
    keyed = rows.withColumn("text_key", F.xxhash64("text")).hint("merge")
    joined = keyed.join(spans, ["ord", "text_key"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_cut_batches, RESULT)
