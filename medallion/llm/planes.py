"""Token-id files of bit-plane shuffled blocks.

Ids are cut into blocks of ``BLOCK_IDS``. Each block of 32-bit ids is transposed into
planes (the k-th byte of every id together, or the k-th bit), and each plane is compressed
by itself, so that the planes ids leave empty cost almost nothing.

File: blocks, then the index, the index's length (8 bytes) and ``MAGIC``. A block is the
number of its ids, the number of its planes and their lengths (4 bytes each), then the
planes as zstandard frames. The index (a zstandard frame of 64-bit integers) holds the
file's number, the number of blocks and of documents, then each block's offset and number
of ids, then each document's id, whether it has one, and its number of ids. All numbers
are little-endian. Files are numbered in the order of the documents in them. Each entry
is followed by one line feed, as the files are written by Spark's text writer; offsets
count it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.store import stored, texts
from medallion.llm.tokens import encoder
from medallion.session import work_dir

BLOCK_IDS = 1 << 16
FILE_TEXT_BYTES = 16 << 20
RANGE_BYTES = 64
END_ID = 2
MAGIC = b"IDPLANE1"
BATCH_CHARS = 1 << 20

DOCUMENTS = "part long, doc_id long, before long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """The byte planes of 32-bit ids, lowest first, or their bit planes."""
    columns = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if not bits:
        return [c.tobytes() for c in columns]
    return [np.packbits((c >> k) & 1).tobytes() for c in columns for k in range(8)]


def from_planes(planes: list[bytes], count: int) -> np.ndarray:
    if len(planes) == 4:
        columns = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    else:
        single = [np.unpackbits(np.frombuffer(p, np.uint8), count=count) for p in planes]
        columns = np.stack([sum(single[8 * c + k] << k for k in range(8)) for c in range(4)]).astype(np.uint8)
    return np.ascontiguousarray(columns.T).view("<u4").reshape(-1)


def pack_block(ids: np.ndarray, bits: bool = False) -> bytes:
    pressed = [zstandard.compress(p, 1) for p in to_planes(ids, bits)]
    head = np.array([len(ids), len(pressed), *map(len, pressed)], dtype="<u4")
    return head.tobytes() + b"".join(pressed)


def unpack_block(data: memoryview) -> np.ndarray:
    count, planes = np.frombuffer(data[:8], "<u4").tolist()
    lengths = np.frombuffer(data[8 : 8 + 4 * planes], "<u4").tolist()
    at, found = 8 + 4 * planes, []
    for length in lengths:
        found.append(zstandard.decompress(data[at : at + length]))
        at += length
    return from_planes(found, count)


def pack_index(part: int, blocks: list[tuple[int, int]], documents: list[tuple[int | None, int]]) -> bytes:
    rows = [part, len(blocks), len(documents)]
    rows += [n for b in blocks for n in b]
    rows += [n for doc_id, count in documents for n in (doc_id or 0, int(doc_id is not None), count)]
    pressed = zstandard.compress(np.array(rows, dtype="<i8").tobytes())
    return pressed + np.array([len(pressed)], dtype="<u8").tobytes() + MAGIC


def unpack_index(data: memoryview) -> tuple[int, np.ndarray, np.ndarray]:
    """``(part, blocks, documents)`` of a whole file."""
    if bytes(data[-9:-1]) != MAGIC:
        raise ValueError("not a file of token-id planes")
    length = int(np.frombuffer(data[-17:-9], "<u8")[0])
    numbers = np.frombuffer(zstandard.decompress(data[-17 - length : -17]), "<i8")
    part, n_blocks, n_documents = numbers[:3].tolist()
    cut = 3 + 2 * n_blocks
    return part, numbers[3:cut].reshape(-1, 2), numbers[cut:].reshape(n_documents, 3)


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[int | None, bytes]]:
    """Each document's id and token ids with the end id, some texts at a time."""
    end = np.array([END_ID], dtype="<u4").tobytes()
    encode = encoder(path).encode_many
    for batch in batches:
        ids, some, chars = [], [], 0
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
            ids.append(doc_id)
            some.append((text or b"").decode("utf-8", "replace"))
            chars += len(some[-1])
            if chars >= BATCH_CHARS:
                yield from zip(ids, (e + end for e in encode(some)))
                ids, some, chars = [], [], 0
        yield from zip(ids, (e + end for e in encode(some)))


def _file_rows(path: str, bits: bool) -> Callable:
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[tuple[int, int]] = []
        documents: list[tuple[int | None, int]] = []
        waiting, held, offset = [], 0, 0

        def row(data: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["value"])

        def block(ids: np.ndarray) -> pa.RecordBatch:
            nonlocal offset
            data = pack_block(ids, bits)
            blocks.append((offset, len(ids)))
            offset += len(data) + 1
            return row(data)

        for doc_id, ids in _encoded(source, path):
            documents.append((doc_id, len(ids) // 4))
            waiting.append(np.frombuffer(ids, "<u4"))
            held += len(waiting[-1])
            if held >= BLOCK_IDS:
                joined = np.concatenate(waiting)
                for at in range(0, held - BLOCK_IDS + 1, BLOCK_IDS):
                    yield block(joined[at : at + BLOCK_IDS])
                waiting, held = [joined[held - held % BLOCK_IDS :]], held % BLOCK_IDS
        if held:
            yield block(np.concatenate(waiting))
        if documents:
            yield row(pack_index(TaskContext.get().partitionId(), blocks, documents))

    return batches


def write(docs: DataFrame, path: str, tokenizer: str, bits: bool = False, file_bytes: int = FILE_TEXT_BYTES) -> None:
    """Encode every whole text of ``docs`` and write files of about ``file_bytes`` of text each.

    Documents are in ascending order of doc_id, rows without one first, rows of one id
    by text. Files are cut by id and the first ``RANGE_BYTES`` of the text, so that the rows
    of an id, or those without one, fill as many files as any others; only texts of one id
    that begin alike stay together. A null text is an empty one, which has just the
    end id. Repeated rows are written as often as they come. An empty table gives no
    files. Other columns are ignored.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Not dealt out by whole texts: the keys sampled for the ranges are then few bytes each.
    start = F.substring("text", 1, RANGE_BYTES)
    ordered = plain.repartitionByRange(int(total // file_bytes) + 1, F.col("doc_id"), start)
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(_file_rows(tokenizer, bits), "value binary")
    rows.select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)


def _document_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            data = memoryview(content.as_buffer())
            if not len(data):
                continue
            part, blocks, documents = unpack_index(data)
            rows, at, held, before = [], 0, np.zeros(0, dtype="<u4"), 0
            for doc_id, known, count in documents.tolist():
                while len(held) < count:
                    held = np.concatenate([held, unpack_block(data[blocks[at][0] :])])
                    at += 1
                rows.append((part, doc_id if known else None, before, count, zlib.crc32(held[:count].tobytes())))
                held, before = held[count:], before + count
            names = [c.split()[0] for c in DOCUMENTS.split(", ")]
            columns = [pa.array(list(c), pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def read_documents(spark, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens and ids_crc32.

    A file is read by one task; its size is bounded by the writer's ``file_bytes``.
    Only one number per file is brought together for ``start``.
    """
    if spark.read.text(path).isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").load(path).select("content")
    found = stored(files.mapInArrow(_document_rows, DOCUMENTS), "token-documents")
    totals = found.groupBy("part").agg(F.sum("n_tokens").alias("of_part"))
    before = F.sum("of_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = totals.select("part", F.coalesce(before, F.lit(0)).alias("carried"))
    return found.join(carried, "part").select(
        "doc_id", (F.col("before") + F.col("carried")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files into the shared folder and read them back, as in ``read_documents``."""
    path = work_dir(docs.sparkSession, "token-files")
    write(docs, path, tokenizer)
    return read_documents(docs.sparkSession, path)
