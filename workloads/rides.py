"""The ride model end to end, on rides derived from order lines."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from medallion.operators.cdc import END_AT, build_target
from medallion.operators.dealing import partitions_of
from medallion.operators.parse import decode_value
from medallion.operators.quality import (
    cancellation_rules,
    fare_rules,
    rules_report,
    timeline_rules,
    unsequenced_report,
)
from medallion.operators.tally import Tally, read_ledger, reconciled
from medallion.plans.pipeline import Lake, run_batch, stage_rides
from medallion.plans.rides import (
    DIM_SPECS,
    FACT_SPEC,
    STAR_KEYS,
    STAR_SPECS,
    dealt_star,
    default_lookups,
    one_big_table,
    star_buckets,
    star_readback,
)
from medallion.schemas import LOOKUPS
from medallion.session import work_dir
from medallion.sources.json_files import ingest_manifest, load_lookups
from medallion.sources.tables import Layer, publish_tables
from workloads.inputs import ride_events, ride_history, without_zone, write_json_array_lines, written_once


def staged(spark: SparkSession, sf: str) -> DataFrame:
    """Bulk history and parsed live events in one table."""
    return stage_rides(decode_value(ride_events(spark, sf)), ride_history(spark, sf))


def obt(spark: SparkSession, sf: str) -> DataFrame:
    return one_big_table(staged(spark, sf), default_lookups(spark))


def stored_obt(spark: SparkSession, sf: str) -> DataFrame:
    """The wide table as stored, which is what the star reads."""
    return written_once(spark, sf, "silver_obt", obt)


def ride_obt(spark: SparkSession, sf: str) -> DataFrame:
    return without_zone(obt(spark, sf))


def manifest_obt(spark: SparkSession, sf: str) -> DataFrame:
    """Lookups copied by a manifest, loaded from the copies, and joined to the rides."""
    base = work_dir(spark, "manifest-obt")
    lookups = default_lookups(spark)
    for name, rows in lookups.items():
        write_json_array_lines(rows, f"{base}/source/{name}.json", LOOKUPS[name].names[0])
    manifest = spark.createDataFrame([(n,) for n in lookups], "file string")
    places = (f"{base}/source/{{file}}.json", f"{base}/raw/{{file}}.json")
    report = ingest_manifest(spark, manifest, *places, schemas=LOOKUPS, multi_line=False)
    failed = report.where("status <> 'Succeeded'").collect()
    if failed:
        raise RuntimeError(f"not copied: {failed}")
    copied = load_lookups(spark, f"{base}/raw", multi_line=False)
    return without_zone(one_big_table(staged(spark, sf), copied))


def ride_target(name: str, spark: SparkSession, sf: str) -> DataFrame:
    spec = next(s for s in STAR_SPECS if s.name == name)
    return without_zone(build_target(stored_obt(spark, sf), spec))


def ride_star(spark: SparkSession, sf: str) -> DataFrame:
    """The star stored as tables, then read back as one."""
    root, schema = work_dir(spark, "ride-star"), f"star_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{root}/schema'")
    layout = star_buckets(partitions_of(spark))
    with dealt_star(stored_obt(spark, sf), root, layout) as frames:
        star = publish_tables(frames, Layer(schema), root, layout)
    return without_zone(star_readback(star))


def ride_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The star published twice under catalog names, and read back by name in SQL."""
    root, schema = work_dir(spark, "ride-catalog"), f"rides_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{root}/schema'")
    layer, layout = Layer(schema, "spark_catalog"), star_buckets(partitions_of(spark))
    for _ in range(2):
        with dealt_star(stored_obt(spark, sf), root, layout) as frames:
            publish_tables(frames, layer, root, layout)
    shown = [f"fact.{c}" for c in FACT_SPEC.columns]
    joins = []
    for name, key in STAR_KEYS:
        columns = next(s for s in DIM_SPECS if s.name == name).columns
        shown += [f"{name}.{c}" for c in columns if c != key]
        now = f" AND {name}.{END_AT} IS NULL" if name == "dim_location" else ""
        joins.append(f"LEFT JOIN {schema}.{name} ON fact.{key} = {name}.{key}{now}")
    fact = f"spark_catalog.{schema}.fact"
    return without_zone(spark.sql(f"SELECT {', '.join(shown)} FROM {fact} fact {' '.join(joins)}"))


def ride_reconciled(spark: SparkSession, sf: str) -> DataFrame:
    """What each stored table received, counted as it was written."""
    root = work_dir(spark, "ride-reconciled")
    tally = Tally(spark, f"{root}/_runs", "first")
    run_batch(ride_events(spark, sf), default_lookups(spark), Lake(root), ride_history(spark, sf), tally=tally)
    return reconciled(read_ledger(spark, f"{root}/_runs")).drop("run")


def ride_quality(spark: SparkSession, sf: str) -> DataFrame:
    rules = {**fare_rules(), **timeline_rules(), **cancellation_rules()}
    return rules_report(staged(spark, sf), rules)


def ride_unplaced(spark: SparkSession, sf: str) -> DataFrame:
    location = next(s for s in DIM_SPECS if s.name == "dim_location")
    return unsequenced_report(stored_obt(spark, sf), location.keys, location.sequence_by)


QUERIES = {
    "ride_obt": ride_obt,
    "manifest_obt": manifest_obt,
    **{f"ride_{s.name}": partial(ride_target, s.name) for s in [*DIM_SPECS, FACT_SPEC]},
    "ride_star": ride_star,
    "ride_catalog": ride_catalog,
    "ride_reconciled": ride_reconciled,
    "ride_quality": ride_quality,
    "ride_unplaced": ride_unplaced,
}
