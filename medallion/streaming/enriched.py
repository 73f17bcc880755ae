"""Enrichment of a stream batch by batch, with lookups as they are at each batch.

A batch reads its lookups anew, so a row that appeared between two batches is found by the
second. Which keys are hot is learnt from the batch before: a sketch of the most
frequent keys is gathered while a batch is written, and the next one spreads just these.
The ledger says of every batch what its lookups were and which keys it found hot.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medallion.operators.enrich import JoinSpec, enrich
from medallion.streaming.changelog import BATCH, COMMITS, GENERATION, NOTHING, commit, commits, generation_of

TOP = 32
HOT_SHARE = 0.05
LEDGER = f"{COMMITS}, alias string, version string, hot array<string>"
GENERATIONS = f"number bigint, {GENERATION} string"

Specs = Callable[[SparkSession], Sequence[JoinSpec]]


def version_of(spark: SparkSession, spec: JoinSpec) -> str:
    """A name for what a lookup holds now: a digest of its files, or of its plan if it has none."""
    lookup = spark.table(spec.table) if isinstance(spec.table, str) else spec.table
    files = sorted(lookup.inputFiles()) or [str(lookup.semanticHash())]
    return hashlib.sha256("\n".join(files).encode()).hexdigest()


def _rows_path(path: str, generation: str, batch: int) -> str:
    return f"{path}/rows/{GENERATION}={generation}/{BATCH}={batch}"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Per batch and lookup: the lookup's version, and the keys that the batch found hot."""
    return spark.read.schema(LEDGER).parquet(f"{path}/ledger/*")


def _numbered(spark: SparkSession, path: str) -> dict[str, int]:
    listed = spark.read.schema(GENERATIONS).parquet(f"{path}/generations/*").collect()
    return {r[GENERATION]: r["number"] for r in listed}


def _hot_keys(found: dict, alias: str, share: float) -> list[str]:
    least = share * found["rows"]
    return [str(top["item"]) for top in found[alias] or [] if top["item"] is not None and top["count"] >= least]


def start_enriched(
    df: DataFrame,
    base_alias: str,
    base_select: Sequence[str],
    specs_of: Specs,
    path: str,
    checkpoint: str,
    where: str = "",
    hot_share: float = HOT_SHARE,
    trigger: str = "availableNow",
) -> StreamingQuery:
    """Start storing ``df`` left-joined with what ``specs_of`` returns at each batch.

    ``trigger`` is ``availableNow`` or a processing-time interval. A spec with ``hot_on`` and
    ``salts`` has those keys spread that made up ``hot_share`` of the batch before. Results
    do not depend on it. A replayed batch replaces itself; it may meet newer lookups.
    """
    spark = df.sparkSession
    generations: list[str] = []
    hot: dict[str, list[str]] = {}

    def resume(batch_id: int) -> None:
        generations.append(generation_of(spark, checkpoint))
        numbered = _numbered(spark, path)
        if generations[0] not in numbered:
            entry = spark.createDataFrame([(len(numbered) + 1, generations[0])], GENERATIONS).coalesce(1)
            entry.write.mode("overwrite").parquet(f"{path}/generations/{len(numbered) + 1}")
        before = (F.col(GENERATION) == generations[0]) & (F.col(BATCH) == batch_id - 1)
        hot.update({r["alias"]: r["hot"] for r in ledger(spark, path).where(before).collect()})

    def store(batch: DataFrame, batch_id: int) -> None:
        if not generations:
            resume(batch_id)
        here = (generations[0], batch_id)
        specs = [replace(s, hot=hot.get(s.alias, ())) if s.hot_on else s for s in specs_of(spark)]
        versions = {s.alias: version_of(spark, s) for s in specs}
        watched = Observation()
        tops = [F.expr(f"approx_top_k(cast({s.hot_on[0]} as string), {TOP})").alias(s.alias) for s in specs if s.hot_on]
        counted = batch.alias(base_alias).observe(watched, F.count(F.lit(1)).alias("rows"), *tops)
        wide = enrich(counted, base_alias, base_select, specs, where)
        wide.write.mode("overwrite").parquet(_rows_path(path, *here))
        found = watched.get
        hot.update({s.alias: _hot_keys(found, s.alias, hot_share) for s in specs if s.hot_on})
        entries = [(*here, s.alias, versions[s.alias], list(hot.get(s.alias, []))) for s in specs]
        entry = spark.createDataFrame(entries, LEDGER).coalesce(1)
        entry.write.mode("overwrite").parquet(f"{path}/ledger/{here[0]}-{batch_id}")
        commit(spark, path, *here)

    shape = enrich(spark.createDataFrame([], df.schema), base_alias, base_select, specs_of(spark), where).schema
    spark.createDataFrame([], shape).write.mode("ignore").parquet(_rows_path(path, NOTHING, -1))
    spark.createDataFrame([], COMMITS).write.mode("ignore").parquet(f"{path}/commits/{NOTHING}")
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(f"{path}/ledger/{NOTHING}")
    spark.createDataFrame([], GENERATIONS).write.mode("ignore").parquet(f"{path}/generations/{NOTHING}")
    writer = (
        df.writeStream.queryName(f"enriched {uuid.uuid4().hex}")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )
    if trigger == "availableNow":
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches that are stored as a whole.

    After a lost checkpoint a source is enriched again from its start, as another
    generation; only the newest generation's rows are shown then.
    """
    schema = spark.read.parquet(_rows_path(path, NOTHING, -1)).schema
    numbered, done = _numbered(spark, path), commits(spark, path)
    newest = max((g for g in done if g in numbered), key=numbered.__getitem__, default=None)
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(_rows_path(path, newest, b) for b in range(done[newest] + 1)))
