import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from medallion.operators.cdc import build_target
from medallion.operators.parse import decode_value
from medallion.plans.pipeline import Lake, run_batch, run_stream_once, stage_rides, start_chain
from medallion.plans.rides import (
    DIM_SPECS,
    FACT_SPEC,
    STAR_SPECS,
    build_star,
    default_lookups,
    one_big_table,
    star_readback,
)
from medallion.schemas import KAFKA_ROW, LOOKUPS, RIDE, RIDE_HISTORY
from medallion.sources.events import read_events
from medallion.streaming.enriched import read_enriched
from workloads.inputs import ride_events, ride_history

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("landing")
    events, history = f"{base}/events", f"{base}/history"
    malformed = spark.createDataFrame([(bytearray(b"<oops>"),)], "value binary")
    live = ride_events(spark, SF).unionByName(malformed, allowMissingColumns=True)
    live.select(*KAFKA_ROW.names).repartition(3).write.parquet(events)
    ride_history(spark, SF).coalesce(1).write.parquet(history)
    return events, history


@pytest.fixture(scope="module")
def batch(spark, landed, tmp_path_factory):
    events, history = (spark.read.parquet(p) for p in landed)
    lake = Lake(str(tmp_path_factory.mktemp("batch")))
    return run_batch(events, default_lookups(spark), lake, history)


def test_tables_and_columns(batch):
    assert set(batch) == {"rides_raw", "stg_rides", "silver_obt", *(s.name for s in STAR_SPECS)}
    assert batch["rides_raw"].columns == [*KAFKA_ROW.names, "rides"]
    assert batch["stg_rides"].columns == RIDE.names
    assert len(batch["silver_obt"].columns) == 58
    assert len(batch["fact"].columns) == 18
    assert batch["dim_location"].columns[-2:] == ["__START_AT", "__END_AT"]


def test_staged_is_history_plus_live(spark, batch, landed):
    events, history = (spark.read.parquet(p).count() for p in landed)
    assert batch["stg_rides"].count() == batch["silver_obt"].count() == events + history
    assert batch["stg_rides"].where("ride_id IS NULL").count() == 1  # the malformed payload


def test_keys_are_unique(batch):
    for spec in [s for s in DIM_SPECS if s.scd_type == 1] + [FACT_SPEC]:
        table = batch[spec.name]
        assert table.count() == table.select(*spec.keys).distinct().count() > 0, spec.name


def test_star_readback_keeps_the_fact(batch):
    wide = star_readback(batch)
    assert wide.count() == batch["fact"].count()
    assert wide.where("passenger_name IS NULL").count() == 0
    assert "__START_AT" not in wide.columns


def test_streams_reach_the_batch_result(spark, batch, landed, tmp_path):
    events, history = landed
    lake = Lake(str(tmp_path))

    def run():
        return run_stream_once(
            read_events(spark, "parquet", {"maxFilesPerTrigger": 2}, KAFKA_ROW, events),
            default_lookups(spark),
            lake,
            read_events(spark, "parquet", schema=RIDE_HISTORY, path=history),
        )

    run()
    tables = run()  # nothing new: nothing may be added
    for name, table in batch.items():
        assert rows(tables[name].select(*table.columns)) == rows(table), name


def test_empty_sources_give_empty_tables(spark, batch, tmp_path):
    (tmp_path / "in").mkdir()
    raw = read_events(spark, "parquet", schema=KAFKA_ROW, path=f"{tmp_path}/in")
    tables = run_stream_once(raw, default_lookups(spark), Lake(f"{tmp_path}/lake"))
    for name, table in tables.items():
        assert table.count() == 0 and set(table.columns) == set(batch[name].columns), name


def test_lookups_as_tables(spark, batch, tmp_path):
    names = {}
    for name, df in default_lookups(spark).items():
        df.createOrReplaceTempView(f"v_{name}")
        names[name] = f"v_{name}"
    out = one_big_table(batch["stg_rides"], names)
    assert out.schema == batch["silver_obt"].schema
    assert out.count() == batch["silver_obt"].count()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_obt_probe_side_is_not_shuffled(spark, batch):
    plan = plan_of(one_big_table(batch["stg_rides"], default_lookups(spark)))
    assert plan.count("BroadcastHashJoin") == len(LOOKUPS)
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_targets_read_only_their_columns(batch):
    obt = batch["silver_obt"]
    for spec in STAR_SPECS:
        plan = plan_of(build_target(obt, spec))
        read = re.search(r"FileScan parquet \[([^]]*)\]", plan).group(1)
        columns = {c.split("#")[0] for c in read.split(",")}
        assert columns == set(spec.source_columns), spec.name
        assert "IsNotNull" in plan  # key filter reaches the scan


def test_dimensions_merge_by_hash(batch):
    for spec in DIM_SPECS:
        plan = plan_of(build_target(batch["silver_obt"], spec))
        scan_up = plan[: plan.index("FileScan")]
        nearest = max(("HashAggregate", "SortAggregate"), key=scan_up.rfind)
        assert nearest == ("HashAggregate" if spec.collapse else "SortAggregate"), spec.name


def test_missing_city_is_left_out_of_location(batch):
    unmatched = batch["silver_obt"].where("pickup_city_id IS NOT NULL AND city_updated_at IS NULL")
    assert unmatched.count() > 0
    ids = {r[0] for r in unmatched.select("pickup_city_id").distinct().collect()}
    assert not ids & {r[0] for r in batch["dim_location"].select("pickup_city_id").collect()}


def test_hot_key_star(spark, batch):
    """A third of all rides by one passenger, twice over, gives the same dimension row."""
    obt = batch["silver_obt"].where("ride_id IS NOT NULL")
    hot = F.when(F.pmod(F.xxhash64("ride_id"), F.lit(3)) == 0, F.lit("hot")).otherwise(F.col("passenger_id"))
    skewed = obt.withColumn("passenger_id", hot)
    star = build_star(skewed.unionByName(skewed))
    once = build_star(skewed)
    assert rows(star["dim_passenger"]) == rows(once["dim_passenger"])
    assert rows(star["fact"]) == rows(once["fact"])


def test_a_running_chain_meets_new_events_and_new_lookup_rows(spark, tmp_path):
    landing, known = f"{tmp_path}/in", f"{tmp_path}/makes"
    ride_events(spark, SF).coalesce(2).write.parquet(f"{tmp_path}/events")
    events = spark.read.parquet(f"{tmp_path}/events")
    lookups = default_lookups(spark)
    makes = lookups["map_vehicle_makes"]
    makes.where("vehicle_make_id <= 3").write.parquet(known)
    first = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    events.where(first).repartition(2).write.parquet(landing)

    def now(session):
        return {**lookups, "map_vehicle_makes": session.read.schema(makes.schema).parquet(known)}

    raw = read_events(spark, "parquet", {"maxFilesPerTrigger": 1}, KAFKA_ROW, landing)
    chain = start_chain(raw, now, Lake(f"{tmp_path}/lake"), [FACT_SPEC], "1 second", max_files=2)
    try:
        assert chain.settle()["fact"].count() > 0
        makes.where("vehicle_make_id > 3").write.mode("append").parquet(known)
        events.where(~first).repartition(2).write.mode("append").parquet(landing)
        late = chain.settle()
    finally:
        chain.stop()
    star = build_star(one_big_table(stage_rides(decode_value(events)), lookups))
    assert rows(late["fact"]) == rows(star["fact"])
    wide = read_enriched(spark, f"{tmp_path}/lake/silver_obt")
    assert wide.count() == events.count()
    assert wide.where("vehicle_make_id BETWEEN 4 AND 7 AND vehicle_make IS NOT NULL").count() > 0
    assert wide.where("vehicle_make_id BETWEEN 4 AND 7 AND vehicle_make IS NULL").count() > 0
