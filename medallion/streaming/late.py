"""Event time kept by the stream itself: what comes too late is set aside, not dropped.

The latest event time of each batch is entered in the ledger. The watermark of a batch is
the latest time of all batches before it, less the allowed delay; rows behind it, and rows
without event time, go to a side table. Of the others the first per key is kept; what it is
compared with are the stored rows of batches that reach past the watermark, so what is
remembered is bounded by time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medallion.operators.cdc import dedup_first
from medallion.streaming.changelog import BATCH, GENERATION, NOTHING, generation_of

REACHED = f"{GENERATION} string, {BATCH} bigint, latest timestamp"
KEPT, LATE = "kept", "late"


def _path(path: str, table: str, generation: str, batch: int) -> str:
    return f"{path}/{table}/{GENERATION}={generation}/{BATCH}={batch}"


def reached(spark: SparkSession, path: str) -> DataFrame:
    """The ledger: each stored batch and the latest event time in it."""
    return spark.read.schema(REACHED).parquet(f"{path}/reached/*")


def start_first_in_time(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    delay: str,
    path: str,
    checkpoint: str,
    trigger: str = "availableNow",
) -> StreamingQuery:
    """Keep the first arrival per key among rows that are in time; set the others aside.

    ``time`` is a timestamp with or without zone, ``delay`` an interval such as "3 minutes". Of rows
    that arrive together the earliest is first. Kept and late rows together are all rows but the
    repeats of kept ones that came in time. A replayed batch replaces itself.
    """
    spark = df.sparkSession
    generations: list[str] = []

    def store(batch: DataFrame, batch_id: int) -> None:
        if not generations:
            generations.append(generation_of(spark, checkpoint))
        here = (generations[0], batch_id)
        before = reached(spark, path).where((F.col(GENERATION) == here[0]) & (F.col(BATCH) < batch_id))
        listed = before.select(BATCH, F.col("latest") - F.expr(f"interval {delay}"), "latest").collect()
        bounds = [r[1] for r in listed if r[1] is not None]
        moment = F.col(time).cast("timestamp")
        in_time = batch.where(moment.isNotNull())
        late = batch.where(moment.isNull())
        if bounds:
            mark = F.lit(max(bounds)).cast("timestamp")
            late = batch.where(moment.isNull() | (moment < mark))
            in_time = batch.where(moment >= mark)
            held = [r[BATCH] for r in listed if r["latest"] is not None and r["latest"] >= max(bounds)]
            known = spark.read.schema(df.schema).parquet(*(_path(path, KEPT, here[0], b) for b in held))
            known = known.where(moment >= mark).select(*(F.col(k).alias(f"__kept{i}") for i, k in enumerate(keys)))
            same = [F.col(k).eqNullSafe(F.col(f"__kept{i}")) for i, k in enumerate(keys)]
            in_time = in_time.join(known, same, "left_anti")
        dedup_first(in_time, keys, [time]).write.mode("overwrite").parquet(_path(path, KEPT, *here))
        late.write.mode("overwrite").parquet(_path(path, LATE, *here))
        entry = batch.agg(F.max(moment).alias("latest")).select(
            F.lit(here[0]).alias(GENERATION), F.lit(batch_id).cast("bigint").alias(BATCH), "latest"
        )
        entry.coalesce(1).write.mode("overwrite").parquet(f"{path}/reached/{here[0]}-{batch_id}")

    for table in (KEPT, LATE):
        spark.createDataFrame([], df.schema).write.mode("ignore").parquet(_path(path, table, NOTHING, -1))
    spark.createDataFrame([], REACHED).write.mode("ignore").parquet(f"{path}/reached/{NOTHING}")
    writer = (
        df.writeStream.queryName(f"in time {uuid.uuid4().hex}")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )
    if trigger == "availableNow":
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def read_in_time(spark: SparkSession, path: str, table: str = KEPT) -> DataFrame:
    """The kept or the late rows of all batches that are in the ledger."""
    schema = spark.read.parquet(_path(path, table, NOTHING, -1)).schema
    stored = [_path(path, table, r[GENERATION], r[BATCH]) for r in reached(spark, path).collect()]
    return spark.read.schema(schema).parquet(*stored) if stored else spark.createDataFrame([], schema)
