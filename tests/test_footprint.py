"""What jobs leave on disk and how often rows travel."""

from __future__ import annotations

from pathlib import Path

from medallion.llm import pii
from medallion.plans.pipeline import Lake, run_batch, run_stream_once
from medallion.plans.rides import STAR_SPECS, default_lookups
from medallion.schemas import KAFKA_ROW
from medallion.sources.tables import Buckets, Layer, publish_tables
from medallion.streaming.publish import to_events
from workloads import inputs, rides


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark, path) -> str:
    orders = spark.sql("SELECT id AS o_orderkey, id % 3 AS o_custkey, timestamp_ntz'2024-01-01' AS o_orderdate FROM range(20)")
    lines = spark.sql(
        "SELECT id % 20 AS l_orderkey, id AS l_partkey, id % 5 AS l_suppkey, cast(id % 7 + 1 AS int) AS l_linenumber, "
        "cast(id AS double) AS l_quantity, 0.1D AS l_discount, if(id % 2 = 0, 'A', 'N') AS l_returnflag FROM range(60)"
    )
    orders.write.parquet(f"{path}/orders.parquet")
    lines.write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def _data_files(path) -> list[str]:
    return [f.name for f in Path(path).rglob("part-*.parquet") if "_checkpoints" not in f.parts]


def test_order_lines_travel_once_and_events_are_not_stored_for_a_batch(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    plan = _plan(inputs.rides(spark, sf))
    assert "RoundRobin" not in plan and plan.count("Exchange hashpartitioning") == 2
    before = dict(inputs._WRITTEN)
    assert rides.ride_obt(spark, sf).count() == 60
    assert inputs._WRITTEN == before


def test_stored_tables_are_compressed(spark, tmp_path):
    value = to_events(spark.createDataFrame([("r-1", 2)], "ride_id string, pickup_city_id long"))
    raw = value.selectExpr("cast(null AS binary) AS key", "cast(value AS binary) AS value")
    run_batch(raw, default_lookups(spark), Lake(f"{tmp_path}/batch"), specs=STAR_SPECS[:1])
    files = _data_files(f"{tmp_path}/batch")
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    raw.write.parquet(f"{tmp_path}/in")
    arriving = spark.readStream.schema(KAFKA_ROW).parquet(f"{tmp_path}/in")
    run_stream_once(arriving, default_lookups(spark), Lake(f"{tmp_path}/stream"), specs=[s for s in STAR_SPECS if s.name == "dim_booking"])
    for name in ("rides_raw", "silver_obt", "dim_booking/state"):
        files = _data_files(f"{tmp_path}/stream/{name}")
        assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_rows_dealt_out_by_the_keys_are_not_dealt_out_again(spark, tmp_path, monkeypatch):
    spark.sql(f"CREATE SCHEMA footprint LOCATION '{tmp_path}/schema'")
    seen = []
    writer = type(spark.range(1).write)
    save = writer.saveAsTable
    monkeypatch.setattr(writer, "saveAsTable", lambda self, name: (seen.append(self._df), save(self, name))[1])
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.sql("SELECT id % 40 AS k, id AS v FROM range(100)").groupBy("k").agg({"v": "max"}).toDF("k", "v")
    try:
        published = publish_tables({"t": rows}, Layer("footprint"), f"{tmp_path}/t", {"t": Buckets(count, ["k"])})
        assert published["t"].count() == 40
    finally:
        spark.sql("DROP SCHEMA footprint CASCADE")
    assert _plan(seen[0]).count("Exchange") == 1


def test_trees_learn_from_all_proposals(spark, monkeypatch):
    docs = spark.sql(
        "SELECT id AS doc_id, if(id % 2 = 0, concat('call +1 555 123 ', 1000 + id % 9000), concat('no 1-555-123-', 1000 + id % 9000)) AS text FROM range(9000)"
    )
    found = {}
    stored = pii.stored
    monkeypatch.setattr(pii, "stored", lambda df, name: found.setdefault(name, stored(df, name)))
    assert pii.train(docs) is not None
    learnt = found["proposals"].selectExpr("inline(proposals)").where("NOT touching").count()
    assert learnt >= 9000
    assert found["forms"].agg({"n": "sum"}).first()[0] == learnt
