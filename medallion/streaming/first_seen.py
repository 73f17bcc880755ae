"""The first arrival per key, remembered in files instead of a state store.

The rows let through are the memory: they are stored in buckets of their key's hash. For
every key let through one bit is set, at a hash, in bitmaps stored beside them. A batch
asks the bitmaps first. A key whose bit is not set is new; only for the others are the
keys of their buckets read. Nothing is held between batches, and a batch costs what its
own keys need.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from medallion.operators.cdc import dedup_first
from medallion.streaming.changelog import BATCH, COMMITS, GENERATION, NOTHING, commit, commits, generation_of

BUCKET = "__bucket"
NUMBER = "__bitmap"
BIT = "__bit"
BUCKETS = 16
BITS = 1 << 24
BITMAPS = f"{NUMBER} bigint, bits binary"


def _rows_path(path: str, generation: str, batch: int) -> str:
    return f"{path}/rows/{GENERATION}={generation}/{BATCH}={batch}"


def _bitmaps_path(path: str, generation: str, batch: int) -> str:
    return f"{path}/bitmaps/{generation}/{batch}"


def _begin(spark: SparkSession, path: str, schema: StructType) -> None:
    spark.createDataFrame([], schema).write.mode("ignore").parquet(_rows_path(path, NOTHING, -1))
    spark.createDataFrame([], COMMITS).write.mode("ignore").parquet(f"{path}/commits/{NOTHING}")


def _stored(spark: SparkSession, path: str, but: tuple[str, int] | None = None) -> list[tuple[str, int]]:
    """The batches stored as a whole, except one that is being written again."""
    every = [(g, b) for g, last in commits(spark, path).items() for b in range(last + 1)]
    return [batch for batch in every if batch != but]


def _read(spark: SparkSession, path: str, schema: StructType, batches: Sequence[tuple[str, int]]) -> DataFrame:
    reader = spark.read.schema(schema).option("basePath", f"{path}/rows")
    return reader.parquet(*(_rows_path(path, g, b) for g, b in batches)).select(*schema.names)


def _is_set(bits: Column, bit: Column) -> Column:
    """Whether a bitmap has this bit; no bitmap has none."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))


def _marked(df: DataFrame, keys: Sequence[str], buckets: int, bits: int) -> DataFrame:
    """Rows with their key's bitmap, its bit in there, and its bucket."""
    place = F.pmod(F.xxhash64(*keys), F.lit(bits))
    return df.withColumns({
        NUMBER: F.bitmap_bucket_number(place),
        BIT: F.bitmap_bit_position(place),
        BUCKET: F.pmod(F.xxhash64(*keys, F.lit(7)), F.lit(buckets)).cast("int"),
    })


def unseen(
    spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], batches: Sequence[tuple[str, int]]
) -> DataFrame:
    """Rows, marked and one per key, whose keys none of the stored batches has let through."""
    if not batches:
        return rows
    bitmaps = spark.read.schema(BITMAPS).parquet(*(_bitmaps_path(path, g, b) for g, b in batches))
    # Only bitmaps that the batch asks for are put together.
    asked = bitmaps.join(rows.select(NUMBER).distinct(), NUMBER, "left_semi")
    known = asked.groupBy(NUMBER).agg(F.bitmap_or_agg("bits").alias("bits"))
    tested = rows.join(known, NUMBER, "left").withColumn("__perhaps", _is_set(F.col("bits"), F.col(BIT))).drop("bits")
    hit = [r[0] for r in tested.where("__perhaps").select(BUCKET).distinct().collect()]
    fresh = tested.where("NOT __perhaps")
    if hit:
        fields = StructType([f for f in rows.schema.fields if f.name in (*keys, BUCKET)])
        seen = _read(spark, path, fields, batches).where(F.col(BUCKET).isin(hit))
        other = seen.select(*(F.col(k).alias(f"__seen{i}") for i, k in enumerate(keys)))
        same = [F.col(k).eqNullSafe(F.col(f"__seen{i}")) for i, k in enumerate(keys)]
        fresh = fresh.unionByName(tested.where("__perhaps").join(other, same, "left_anti"))
    return fresh.select(*rows.columns)


def start_first_seen(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    path: str,
    checkpoint: str,
    buckets: int = BUCKETS,
    bits: int = BITS,
    trigger: str = "availableNow",
) -> StreamingQuery:
    """Let the first row per key through to ``path``: of the first batch that has it, the first by ``order_by``.

    A null key is a key. ``bits`` should be several times the number of keys expected; with
    fewer, more batches read buckets, and results are the same. ``buckets`` and ``bits`` are
    fixed by the first run. A lost checkpoint lets nothing through again.
    """
    spark = df.sparkSession
    generations: list[str] = []

    def store(batch: DataFrame, batch_id: int) -> None:
        if not generations:
            generations.append(generation_of(spark, checkpoint))
        here = (generations[0], batch_id)
        first = _marked(dedup_first(batch, keys, order_by), keys, buckets, bits)
        fresh = unseen(spark, path, first, keys, _stored(spark, path, but=here))
        fresh.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(_rows_path(path, *here))
        written = _read(spark, path, first.select(NUMBER, BIT).schema, [here])
        maps = written.groupBy(NUMBER).agg(F.bitmap_construct_agg(BIT).alias("bits"))
        maps.write.mode("overwrite").parquet(_bitmaps_path(path, *here))
        commit(spark, path, *here)

    _begin(spark, path, df.schema)
    writer = (
        df.writeStream.queryName(f"first seen {uuid.uuid4().hex}")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )
    if trigger == "availableNow":
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def read_first_seen(spark: SparkSession, path: str) -> DataFrame:
    """The rows let through by all batches that are stored as a whole."""
    schema = spark.read.parquet(_rows_path(path, NOTHING, -1)).schema
    batches = _stored(spark, path)
    if not batches:
        return spark.createDataFrame([], schema)
    return _read(spark, path, schema, batches)
