"""Raw events to star schema, stage by stage, in batch or as a chain of streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from medallion.operators.cdc import CdcSpec, build_target, unsequenced
from medallion.operators.dealing import dealt, partitions_of
from medallion.operators.flows import append_flows
from medallion.operators.parse import cast_event_time, decode_value, parse_json
from medallion.operators.tally import Tally, placed_counts
from medallion.plans.rides import STAR_SPECS, join_specs, one_big_table
from medallion.schemas import RIDE
from medallion.sources.tables import CODEC
from medallion.streaming.changelog import start_changes
from medallion.streaming.enriched import read_enriched, start_enriched
from medallion.streaming.runs import run_stream, start_stream, watermark
from medallion.streaming.targets import refresh_targets


@dataclass(frozen=True)
class Lake:
    """The folder that holds a pipeline's tables and checkpoints.

    ``log_checkpoints`` names another folder for those of the star's logs, as after a loss.
    """

    root: str
    log_checkpoints: str = "_checkpoints"

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def log(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_changes/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{name}"

    def log_checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.log_checkpoints}/{name}"


def stage_rides(raw: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Parsed live rides and, if given, the bulk history, in one set of columns."""
    live = parse_json(raw, "rides", RIDE)
    if history is None:
        return live
    return append_flows(cast_event_time(history, "booking_timestamp").select(*RIDE.names), live)


def split_rides(raw: DataFrame, history: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """As ``stage_rides``, without the payloads that can't be read, which come second, as they arrived."""
    live, bad = parse_json(raw, "rides", RIDE, mode="quarantine")
    if history is None:
        return live, bad
    return append_flows(cast_event_time(history, "booking_timestamp").select(*RIDE.names), live), bad


def unplaced_rides(obt: DataFrame, spec: CdcSpec) -> DataFrame:
    """Rows that a target leaves out, as they have no key or no sequence."""
    return unsequenced(obt.select(*spec.source_columns), spec.keys, spec.sequence_by)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_targets(targets: Mapping[str, DataFrame], lake: Lake) -> dict[str, DataFrame]:
    """Store independent tables at the same time.

    Joins over the star should read these: their sizes are known to the planner,
    so small dimensions are broadcast before the fact is ever shuffled for them.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(targets))) as pool:
        stored = pool.map(lambda t: _stored(t[1], lake.table(t[0])), targets.items())
        return dict(zip(targets, stored))


def run_batch(
    raw: DataFrame,
    lookups: Mapping[str, DataFrame | str],
    lake: Lake,
    history: DataFrame | None = None,
    specs: Sequence[CdcSpec] = tuple(STAR_SPECS),
    tally: Tally | None = None,
    set_aside: bool = False,
) -> dict[str, DataFrame]:
    """Build every table from scratch; returns the tables by name.

    The one-big-table is stored before the star is built, so each of the star's
    tables scans only its own columns; those of type 1 are dealt out through files. With a
    ``tally``, rows that hold a ride and rows that a target can place are counted against all
    as they are written. With ``set_aside``,
    payloads that can't be read go to ``quarantine`` instead of becoming rows of nulls, and
    what a target can't place to ``unplaced_`` and its name.
    """

    def watched(df: DataFrame, name: str, measures: Mapping[str, Column]) -> DataFrame:
        return df if tally is None else tally.watch(df, name, measures)

    tables = {"rides_raw": _stored(decode_value(raw), lake.table("rides_raw"))}
    if set_aside:
        staged, bad = split_rides(tables["rides_raw"], history)
        tables["quarantine"] = _stored(bad, lake.table("quarantine"))
    else:
        staged = stage_rides(tables["rides_raw"], history)
    staged = watched(staged, "stg_rides", _held_counts(RIDE.names))
    tables["stg_rides"] = _stored(staged, lake.table("stg_rides"))
    tables["silver_obt"] = _stored(
        one_big_table(tables["stg_rides"], lookups), lake.table("silver_obt")
    )
    targets, spark = {}, raw.sparkSession
    with ExitStack() as held:
        for spec in specs:
            rows = tables["silver_obt"].select(*spec.source_columns)
            watch = partial(watched, name=spec.name, measures=placed_counts(spec))
            if spec.scd_type == 1:
                by_key = dealt(rows, spec, spec.keys, partitions_of(spark), lake.root, watch)
                targets[spec.name] = build_target(held.enter_context(by_key), spec)
            else:
                targets[spec.name] = build_target(watch(rows), spec)
            if set_aside:
                targets[f"unplaced_{spec.name}"] = unplaced_rides(tables["silver_obt"], spec)
        tables |= store_targets(targets, lake)
    if tally is not None:
        tally.enter()
    return tables


def _held_counts(columns: Sequence[str]) -> dict[str, Column]:
    """A payload that could not be read became a row of nulls."""
    empty = F.count_if(F.coalesce(*(F.col(c).cast("string") for c in columns)).isNull())
    rows = F.count(F.lit(1))
    return {"received": rows, "placed": rows - empty, "unplaced": empty}


def _stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_stream_once(
    raw: DataFrame,
    lookups: Mapping[str, DataFrame | str],
    lake: Lake,
    history: DataFrame | None = None,
    specs: Sequence[CdcSpec] = tuple(STAR_SPECS),
    set_aside: bool = False,
) -> dict[str, DataFrame]:
    """Take in what is new in the streams ``raw`` and ``history``; returns the tables.

    A rerun continues at the checkpoints: stored history is not read again. The
    star's logs are independent of each other and fill at the same time; of the
    star's tables, the buckets that hold changed keys are then refreshed. They read
    the stored one-big-table without its watermark, so late rides count. ``set_aside`` is
    as for a batch; the tables set aside grow like the others.
    """
    spark = raw.sparkSession

    def store(df: DataFrame, name: str) -> DataFrame:
        run_stream(df, lake.checkpoint(name), path=lake.table(name))
        return _stream(spark, lake.table(name), df.schema)

    raw_stored = store(decode_value(raw), "rides_raw")
    aside = {}
    if set_aside:
        good, bad = split_rides(raw_stored, history)
        aside["quarantine"] = store(bad, "quarantine")
    else:
        good = stage_rides(raw_stored, history)
    staged = store(good, "stg_rides")
    enriched = one_big_table(watermark(staged, "booking_timestamp"), lookups)
    obt = store(enriched, "silver_obt")

    running = [
        start_changes(obt, spec, lake.log(spec.name), lake.log_checkpoint(spec.name))
        for spec in specs
    ]
    for query in running:
        query.awaitTermination()
    if set_aside:
        aside |= {f"unplaced_{s.name}": store(unplaced_rides(obt, s), f"unplaced_{s.name}") for s in specs}

    streams = {"rides_raw": raw_stored, "stg_rides": staged, "silver_obt": obt, **aside}
    tables = {
        name: spark.read.schema(df.schema).parquet(lake.table(name)) for name, df in streams.items()
    }
    targets = [(spec, lake.log(spec.name), lake.table(spec.name)) for spec in specs]
    return {**tables, **refresh_targets(spark, targets)}


@dataclass
class Chain:
    """Running streams from raw events to the star's logs, in the order that data takes."""

    spark: SparkSession
    queries: list[StreamingQuery]
    targets: list[tuple[CdcSpec, str, str]]

    def settle(self) -> dict[str, DataFrame]:
        """Wait until all that has arrived is logged, refresh the star, and return it."""
        for query in self.queries:
            query.processAllAvailable()
        return refresh_targets(self.spark, self.targets)

    def stop(self) -> None:
        for query in self.queries:
            query.stop()


def start_chain(
    raw: DataFrame,
    lookups_of: Callable[[SparkSession], Mapping[str, DataFrame | str]],
    lake: Lake,
    specs: Sequence[CdcSpec] = tuple(STAR_SPECS),
    trigger: str = "1 minute",
    max_files: int | None = None,
) -> Chain:
    """Start a chain that keeps running, one micro-batch per ``trigger`` and stage.

    Each batch of the wide table meets the lookups as ``lookups_of`` returns them then.
    ``max_files`` limits the files a stage takes in at once; limit ``raw`` where it is read.
    Started again it continues at its checkpoints. The star is refreshed by ``settle``, at
    whatever interval its readers need.
    """
    spark = raw.sparkSession
    queries = []

    def store(df: DataFrame, name: str) -> DataFrame:
        where = {"path": lake.table(name)}
        # One round makes the table that the next stage watches; the stream then goes on.
        run_stream(df, lake.checkpoint(name), **where)
        queries.append(start_stream(df, lake.checkpoint(name), trigger=trigger, **where))
        return _stream(spark, lake.table(name), df.schema, max_files)

    staged = store(stage_rides(store(decode_value(raw), "rides_raw")), "stg_rides")
    wide, columns = lake.table("silver_obt"), [f"r.{c}" for c in RIDE.names]

    def enrichment(when: str) -> StreamingQuery:
        specs_of = lambda session: join_specs(lookups_of(session))
        return start_enriched(staged, "r", columns, specs_of, wide, lake.checkpoint("silver_obt"), trigger=when)

    enrichment("availableNow").awaitTermination()
    queries.append(enrichment(trigger))
    shape = read_enriched(spark, wide).schema
    obt = _stream(spark, f"{wide}/rows", shape, max_files).select(*shape.names)
    queries += [start_changes(obt, s, lake.log(s.name), lake.log_checkpoint(s.name), trigger) for s in specs]
    return Chain(spark, queries, [(s, lake.log(s.name), lake.table(s.name)) for s in specs])
