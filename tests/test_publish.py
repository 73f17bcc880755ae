import re
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from medallion.operators.cdc import CdcSpec
from medallion.operators.tally import Tally, placed_counts, read_ledger, reconciled
from medallion.plans.pipeline import Lake, run_batch, run_stream_once
from medallion.plans.rides import FINE, STAR_SPECS, build_star, default_lookups, star_buckets, star_readback
from medallion.sources.events import read_events
from medallion.sources.tables import Buckets, Layer, publish_tables
from workloads.inputs import raw_rides
from workloads.rides import stored_obt

SF = "/root/testdata/sf0.001"


@pytest.fixture
def layer(spark, tmp_path):
    schema = f"pub_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path}/schema'")
    return Layer(schema, "spark_catalog")


def frame(spark, start, count=50):
    return spark.range(start, start + count).select("id", F.concat(F.lit("v"), "id").alias("v"))


def names(spark, layer):
    return {t.name for t in spark.catalog.listTables(layer.schema)}


def test_a_new_version_replaces_the_old_under_one_name(spark, tmp_path, layer):
    for start in (0, 100, 200):
        out = publish_tables({"a": frame(spark, start), "b": frame(spark, start, 3)}, layer, f"{tmp_path}/t")
        assert rows(out["a"]) == rows(frame(spark, start)) == rows(spark.sql(f"SELECT * FROM {layer.schema}.a"))
        assert rows(spark.sql(f"SELECT * FROM spark_catalog.{layer.schema}.b")) == rows(frame(spark, start, 3))
    assert names(spark, layer) == {"a", "b"}


def test_a_reader_that_has_begun_finishes(spark, tmp_path, layer):
    publish_tables({"a": frame(spark, 0)}, layer, f"{tmp_path}/t")
    begun = spark.table(layer.name("a")).where("id >= 0")
    publish_tables({"a": frame(spark, 100)}, layer, f"{tmp_path}/t")
    assert rows(begun) == rows(frame(spark, 0))
    assert rows(spark.table(layer.name("a"))) == rows(frame(spark, 100))


def test_a_failed_run_shows_nothing(spark, tmp_path, layer):
    publish_tables({"a": frame(spark, 0), "b": frame(spark, 0)}, layer, f"{tmp_path}/t")
    broken = frame(spark, 5).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        publish_tables({"a": frame(spark, 5), "b": broken}, layer, f"{tmp_path}/t")
    assert rows(spark.table(layer.name("a"))) == rows(spark.table(layer.name("b"))) == rows(frame(spark, 0))
    assert names(spark, layer) == {"a", "b"}


def test_columns_and_buckets_may_change(spark, tmp_path, layer):
    root = f"{tmp_path}/t"
    publish_tables({"a": frame(spark, 0)}, layer, root)
    wider = frame(spark, 0).withColumn("w", F.lit(1))
    assert rows(publish_tables({"a": wider}, layer, root)["a"]) == rows(wider)
    for count in (4, 4, 2):
        out = publish_tables({"a": wider}, layer, root, {"a": Buckets(count, ["id"])})["a"]
        assert rows(out) == rows(wider)
    shown = {r[0]: r[1] for r in spark.sql(f"DESCRIBE FORMATTED {layer.name('a')}").collect()}
    assert shown["Num Buckets"] == "2"
    assert publish_tables({}, layer, root) == {}


def test_large_tables_of_the_star_join_where_they_lie(spark, tmp_path, layer):
    plain = build_star(stored_obt(spark, SF))
    star = publish_tables(plain, layer, f"{tmp_path}/t", star_buckets(4))
    wide = star_readback(star)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = star["fact"].join(star["dim_booking"], "ride_id", "left")
        both.collect()
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        whole = star_readback(star)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning\(ride_id", whole)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert set(FINE) <= set(star) and rows(wide) == rows(star_readback(plain))


def test_counts_are_taken_as_rows_are_written(spark, tmp_path):
    spec = CdcSpec("t", ["k"], ["k"], "s")
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1), ("b", 2)], "k string, s bigint")
    for run in ("one", "two", "two"):
        tally = Tally(spark, f"{tmp_path}/runs", run)
        tally.watch(df, "t", placed_counts(spec)).write.mode("overwrite").parquet(f"{tmp_path}/out")
        tally.watch(df.limit(0), "none", placed_counts(spec)).write.mode("overwrite").parquet(f"{tmp_path}/none")
        entered = tally.enter()
        assert entered.count() == 6
    found = reconciled(read_ledger(spark, f"{tmp_path}/runs"))
    assert rows(found) == [(r, n, *c, True) for r in ("one", "two") for n, c in (("none", (0, 0, 0)), ("t", (4, 2, 2)))]


def test_a_batch_run_accounts_for_every_row(spark, tmp_path):
    malformed = spark.createDataFrame([(bytearray(b"<oops>"),), (bytearray(b""),)], "value binary")
    raw = raw_rides(spark, SF).unionByName(malformed, allowMissingColumns=True)
    tally = Tally(spark, f"{tmp_path}/runs", "run")
    tables = run_batch(raw, default_lookups(spark), Lake(f"{tmp_path}/lake"), tally=tally)
    counts = {r["name"]: r for r in reconciled(read_ledger(spark, f"{tmp_path}/runs")).collect()}
    assert set(counts) == {"stg_rides", *(s.name for s in STAR_SPECS)} and all(r["ok"] for r in counts.values())
    total = tables["stg_rides"].count()
    assert (counts["stg_rides"]["received"], counts["stg_rides"]["unplaced"]) == (total, 2)
    without = tables["silver_obt"].where("passenger_id IS NULL OR ride_id IS NULL OR pickup_city_id IS NULL")
    assert counts["fact"]["unplaced"] == without.count() > 2


def test_what_cannot_be_read_or_placed_is_stored(spark, tmp_path):
    malformed = spark.createDataFrame([(bytearray(b"<oops>"),), (bytearray(b""),)], "value binary")
    raw = raw_rides(spark, SF).unionByName(malformed, allowMissingColumns=True)
    raw.write.parquet(f"{tmp_path}/in")
    tables = run_batch(spark.read.parquet(f"{tmp_path}/in"), default_lookups(spark), Lake(f"{tmp_path}/batch"), set_aside=True)
    assert sorted(bytes(r["value"]) for r in tables["quarantine"].collect()) == [b"", b"<oops>"]
    assert tables["stg_rides"].count() == tables["rides_raw"].count() - 2
    for spec in STAR_SPECS:
        placed = tables["silver_obt"].dropna(subset=list({*spec.keys, spec.sequence_by}))
        assert tables[f"unplaced_{spec.name}"].count() == tables["silver_obt"].count() - placed.count(), spec.name
    arriving = read_events(spark, "parquet", schema=tables["rides_raw"].drop("rides").schema, path=f"{tmp_path}/in")
    for _ in range(2):
        streamed = run_stream_once(arriving, default_lookups(spark), Lake(f"{tmp_path}/stream"), set_aside=True)
    assert set(streamed) == set(tables)
    for name, table in tables.items():
        assert streamed[name].count() == table.count(), name
