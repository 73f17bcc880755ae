"""Chat formatting as prefix trees.

Conversations that begin with the same turns share them: every distinct beginning is a
node of a tree, and its tokens are emitted once. Trees are laid out depth first, so that
a token sees the intervals of its node's ancestors and what precedes it in its own node;
its position is counted along its own conversation.

A node's key is a hash chained along its turns. Distinct conversations are sorted by
their keys in range partitions; each owns the nodes it doesn't share with the one before
it, which is the depth-first order. Offsets are running totals, so no tree, however
common its first turn, is ever held by one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.store import in_parts, stored, with_running_total
from medallion.llm.tokens import encoder
from medallion.session import work_dir

OPEN, CLOSE = "<turn>", "</turn>\n"
LEARNT = "assistant"
_CONTROL = re.compile(r"\\|<(?=/?turn>)")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """No string of the template is left, and ``unescape`` gives the text back."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def node_key(parent: bytes, role: str, text: str) -> bytes:
    data = role.encode("utf-8", "replace")
    head = len(data).to_bytes(8, "little") + data
    return hashlib.blake2b(parent + head + text.encode("utf-8", "replace"), digest_size=16).digest()


PATHS = "conv_id long, path array<binary>, roles array<string>, texts array<string>"


def _path_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, roles, said = [], [], []
        for turns in batch.column("turns"):
            turns = turns.as_py()
            path, parent = [], b""
            for turn in turns:
                parent = node_key(parent, turn["role"], turn["text"])
                path.append(parent)
            paths.append(path)
            roles.append([t["role"] for t in turns])
            said.append([t["text"] for t in turns])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                pa.array(paths, pa.list_(pa.binary())),
                pa.array(roles, pa.list_(pa.string())),
                pa.array(said, pa.list_(pa.string())),
            ],
            names=["conv_id", "path", "roles", "texts"],
        )


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """Per conversation its turns in order of turn, role and text, and the keys of its beginnings."""
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    plain = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    grouped = plain.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return grouped.mapInArrow(_path_batches, PATHS)


NODES = "node binary, ids array<int>, n_tokens long, loss_start long, loss_end long"


def _node_batches(tokenizer: str) -> Callable:
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_many
        for batch in source:
            roles, said = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            heads = encode([f"{OPEN}{escape_role(r)}\n" for r in roles])
            bodies = encode([escape(t) for t in said])
            tail = encode([CLOSE])[0]
            ids = [np.frombuffer(h + b + tail, "<u4").astype(np.int32) for h, b in zip(heads, bodies)]
            starts = [len(h) // 4 for h in heads]
            ends = [s + len(b) // 4 if r == LEARNT else s for s, b, r in zip(starts, bodies, roles)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array(ids, pa.list_(pa.int32())),
                    *(pa.array(c, pa.int64()) for c in ([len(i) for i in ids], starts, ends)),
                ],
                names=["node", "ids", "n_tokens", "loss_start", "loss_end"],
            )

    return batches


def _depth_first(paths: DataFrame, parts: int) -> DataFrame:
    """``(part, row, leaf, path, shared)``: distinct conversations in order, and how many
    beginnings each shares with the one before it."""
    leaves = paths.select(F.element_at("path", -1).alias("leaf"), "path").groupBy("leaf").agg(F.first("path").alias("path"))
    placed = in_parts(leaves, "ordered-paths", parts, "path")
    last = placed.groupBy("part").agg(F.max("path").alias("last"))
    before = last.select("part", F.lag("last").over(Window.orderBy("part")).alias("carried"))
    in_part = Window.partitionBy("part").orderBy("path")
    rows = placed.withColumns({"row": F.row_number().over(in_part), "previous": F.lag("path").over(in_part)})
    rows = rows.join(before, "part")
    previous = F.coalesce("previous", "carried")
    # Keys are chained, so equal keys stand at equal places and after equal beginnings.
    shared = F.coalesce(F.size(F.array_intersect("path", previous)), F.lit(0))
    return rows.select("part", "row", "leaf", "path", F.when(previous.isNull(), 0).otherwise(shared).alias("shared"))


LAID = "node binary, parent binary, depth long, position long, attention array<struct<start: long, end: long>>"


def _ancestor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the nodes a conversation owns: position of the first token, and the ancestors' intervals, merged."""
    interval = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        rows = []
        for shared, line in zip(batch.column("shared").to_pylist(), batch.column("line")):
            position, seen, parent = 0, [], None
            for depth, step in enumerate(line.as_py()):
                if depth >= shared:
                    rows.append((step["node"], parent, depth, position, [{"start": a, "end": b} for a, b in seen]))
                start, end = step["start"], step["start"] + step["n_tokens"]
                seen = [*seen[:-1], (seen[-1][0], end)] if seen and seen[-1][1] == start else [*seen, (start, end)]
                position, parent = position + step["n_tokens"], step["node"]
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(interval)]
        columns = zip(*rows) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)],
            names=["node", "parent", "depth", "position", "attention"],
        )


def format_trees(conversations: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """``(nodes, paths)``, written to the shared folder and read back.

    nodes: tree, start (of its tokens in the tree's sequence), node, parent, depth, ids,
    position_ids, loss_mask, and attention: the intervals of the tree's sequence that
    its tokens see besides their own node. paths: conv_id and its nodes in order.

    Null roles and texts are empty ones. Turns with the same number are in order of role
    and text; a null number comes first. Repeated rows are turns of their own. Rows
    without conv_id are one conversation. An empty table gives no nodes and no paths.
    Other columns are ignored. One conversation is held by one task, as it is one
    training example; a tree is not.
    """
    spark = conversations.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = stored(conversation_paths(conversations), "conversation-paths")
    turns = paths.select(F.posexplode(F.arrays_zip("path", "roles", "texts")).alias("depth", "turn"))
    distinct = turns.groupBy(F.col("turn.path").alias("node")).agg(
        F.first("turn.roles").alias("role"), F.first("turn.texts").alias("text")
    )
    nodes = stored(distinct.mapInArrow(_node_batches(tokenizer), NODES), "nodes")

    order = stored(_depth_first(paths, parts), "depth-first")
    own = order.select(
        "part", "row", F.element_at("path", 1).alias("tree"),
        F.posexplode(F.slice("path", F.col("shared") + 1, F.size("path") - F.col("shared"))).alias("at", "node"),
    )
    counted = stored(own.join(nodes.select("node", "n_tokens"), "node"), "counted")
    total = with_running_total(counted, "n_tokens", "offset", "row", "at")
    total = stored(total.select("tree", "node", "n_tokens", "offset"), "offsets")
    roots = total.where("tree = node").select("tree", F.col("offset").alias("root_offset"))
    placed = total.join(roots, "tree").select(
        "tree", "node", "n_tokens", (F.col("offset") - F.col("root_offset")).alias("start")
    )
    placed = stored(placed, "placed")

    steps = order.select("leaf", "shared", F.posexplode("path").alias("depth", "node"))
    lines = steps.join(placed.drop("tree"), "node").groupBy("leaf").agg(
        F.first("shared").alias("shared"),
        F.sort_array(F.collect_list(F.struct("depth", "node", "start", "n_tokens"))).alias("line"),
    )
    laid = lines.select("shared", "line").mapInArrow(_ancestor_batches, LAID)
    out = laid.join(placed.drop("n_tokens"), "node").join(nodes, "node").select(
        "tree", "start", "node", "parent", "depth", "ids",
        F.transform("ids", lambda _, i: (F.col("position") + i).cast("int")).alias("position_ids"),
        F.transform("ids", lambda _, i: (i >= F.col("loss_start")) & (i < F.col("loss_end"))).alias("loss_mask"),
        "attention",
    )
    base = work_dir(spark, "chat")
    out.write.parquet(f"{base}/nodes")
    paths.select("conv_id", "path").write.parquet(f"{base}/paths")
    return spark.read.schema(out.schema).parquet(f"{base}/nodes"), spark.read.parquet(f"{base}/paths")


READ = "node binary, said string, learnt string, chars long"


def _read_batches(tokenizer: str) -> Callable:
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(tokenizer).decode
        for batch in source:
            said, learnt, chars = [], [], []
            for ids, mask in zip(batch.column("ids"), batch.column("loss_mask")):
                ids = np.array(ids.as_py(), dtype=np.int64)
                text = decode(ids)
                head, _, rest = text.removeprefix(OPEN).partition("\n")
                said.append(f"{unescape(head)}\n{unescape(rest.removesuffix(CLOSE))}\n")
                learnt.append(unescape(decode(ids[np.array(mask.as_py(), dtype=bool)])))
                chars.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(said), pa.array(learnt), pa.array(chars, pa.int64())],
                names=["node", "said", "learnt", "chars"],
            )

    return batches


def read_conversations(nodes: DataFrame, paths: DataFrame, tokenizer: str) -> DataFrame:
    """Per conversation what its nodes say, all of it and under the loss mask, with digests."""
    read = stored(nodes.select("node", "ids", "loss_mask").mapInArrow(_read_batches(tokenizer), READ), "read-nodes")
    steps = paths.select("conv_id", F.posexplode("path").alias("depth", "node")).join(read, "node")
    lines = steps.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("depth", "said", "learnt", "chars"))).alias("line")
    )
    said, learnt = F.array_join("line.said", ""), F.array_join("line.learnt", "")
    return lines.select(
        "conv_id",
        F.size("line").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.aggregate("line.chars", F.lit(0).cast("long"), lambda a, b: a + b).alias("formatted_chars"),
    )
