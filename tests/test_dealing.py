"""Rows dealt out by key through files instead of a shuffle."""

from __future__ import annotations

from pathlib import Path

from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from medallion.operators.cdc import CdcSpec, build_target
from medallion.operators.dealing import SLOT, dealt, hot_hashes, slot_of
from medallion.plans import pipeline
from medallion.plans.rides import STAR_SPECS, dealt_star, default_lookups, one_big_table, star_buckets
from medallion.schemas import RIDE
from medallion.sources.tables import Buckets
from medallion.streaming import changelog, targets

SPEC = CdcSpec("fine", ["k", "v"], ["k"], "s")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _source(spark, hot=0):
    """300 rows of 100 keys, and ``hot`` more of one key; some without key or sequence."""
    return spark.sql(
        "SELECT if(id % 50 = 7, null, if(id >= 300, 3, id % 100)) AS k, if(id % 60 = 9, null, id % 7) AS s, id AS v "
        f"FROM range({300 + hot})"
    )


def _left(path) -> list[str]:
    return [f.name for f in Path(path).rglob("*.parquet")]


def _log(spark, log, batch, df):
    changelog._begin(spark, log, df.schema)
    df.write.parquet(changelog._batch_path(log, "g", batch))
    changelog.commit(spark, log, "g", batch)


def test_a_fine_target_is_refreshed_and_compacted_without_a_shuffle(spark, tmp_path, monkeypatch):
    log, path, seen = f"{tmp_path}/log", f"{tmp_path}/target", []
    save, reduce = targets._save, changelog.reduce_changes
    monkeypatch.setattr(targets, "_save", lambda df, *a: (seen.append(_plan(df)), save(df, *a))[1])
    monkeypatch.setattr(changelog, "reduce_changes", lambda df, spec: (seen.append(_plan(reduce(df, spec))), reduce(df, spec))[1])
    source = _source(spark).select(*SPEC.source_columns)
    _log(spark, log, 0, source.where("v % 2 = 0"))
    assert targets.refresh_target(spark, log, SPEC, path, 4) == 4
    changelog.compact(spark, log, SPEC)
    _log(spark, log, 1, source.where("v % 2 = 1"))
    targets.refresh_target(spark, log, SPEC, path, 4)
    assert len(seen) == 3 and not any("Exchange" in plan for plan in seen)
    expected = rows(build_target(source, SPEC))
    assert rows(targets.read_target(spark, log, SPEC, path)) == expected == rows(changelog.target_view(spark, log, SPEC))
    assert not _left(f"{path}/_dealt") and not _left(f"{log}/_dealt")


def test_hot_keys_are_reduced_before_and_all_rows_are_seen_once(spark, tmp_path):
    source, seen = _source(spark, hot=300), Observation()
    assert hot_hashes(source.where("k IS NOT NULL"), ["k"], 0.3) == [source.where("k = 3").select(F.xxhash64("k")).first()[0]]
    watch = lambda df: df.observe(seen, F.count(F.lit(1)).alias("n"))
    with dealt(source, SPEC, ["k"], 8, str(tmp_path), watch) as by_key:
        assert by_key.where("k = 3").count() == 1
        assert rows(build_target(by_key, SPEC)) == rows(build_target(source, SPEC))
    assert seen.get["n"] == 600
    assert not _left(tmp_path)


def test_a_slot_is_the_bucket_of_its_number(spark, tmp_path):
    part = F.pmod(F.xxhash64("k"), F.lit(12))
    slotted = _source(spark).withColumn(SLOT, slot_of(spark, part, 12)).withColumn("part", part)
    with dealt(slotted, SPEC, [SLOT], 12, str(tmp_path)) as by_slot:
        assert "Exchange" not in _plan(by_slot.groupBy("k", SLOT).agg(F.count(F.lit(1))))
        assert by_slot.select(F.pmod(F.hash(SLOT), F.lit(12)) != F.col("part")).distinct().collect() == [(False,)]


def _wide(spark, path):
    rides = spark.range(40).select(
        *(F.concat(F.lit(f.name), F.col("id") % 30).cast(f.dataType).alias(f.name) if f.dataType.simpleString() == "string"
          else F.lit(None).cast(f.dataType).alias(f.name) for f in RIDE.fields)
    ).withColumns({"pickup_city_id": F.lit(1).cast("bigint"), "payment_method_id": F.lit(2).cast("bigint")})
    one_big_table(rides, default_lookups(spark)).write.parquet(path)
    return spark.read.parquet(path)


def test_tables_with_a_layout_are_dealt_out_once(spark, tmp_path):
    obt = _wide(spark, f"{tmp_path}/obt")
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with dealt_star(obt, f"{tmp_path}/root", star_buckets(count)) as star:
        for spec in STAR_SPECS:
            assert rows(star[spec.name]) == rows(build_target(obt, spec))
        for name in ("fact", "dim_booking"):
            assert "Exchange" not in _plan(star[name].repartition("ride_id"))
    assert not _left(f"{tmp_path}/root")
    with dealt_star(obt, f"{tmp_path}/root", {"dim_payment": Buckets(2, ["payment_method_id"])}) as star:
        assert rows(star["dim_payment"]) == rows(build_target(obt, next(s for s in STAR_SPECS if s.name == "dim_payment")))


def test_a_batch_stores_fine_targets_without_a_shuffle(spark, tmp_path, monkeypatch):
    plans, stored = {}, pipeline._stored
    monkeypatch.setattr(pipeline, "_stored", lambda df, path: (plans.update({path: _plan(df)}), stored(df, path))[1])
    raw = spark.sql("SELECT cast(null AS binary) AS key, cast(concat('{\"ride_id\":\"r', id % 3, '\"}') AS binary) AS value FROM range(9)")
    lake = pipeline.Lake(f"{tmp_path}/lake")
    booking = next(s for s in STAR_SPECS if s.name == "dim_booking")
    tables = pipeline.run_batch(raw, default_lookups(spark), lake, specs=[booking])
    assert rows(tables["dim_booking"].select("ride_id")) == [("r0",), ("r1",), ("r2",)]
    assert "Exchange" not in plans[lake.table("dim_booking")]
    assert not _left(f"{lake.root}/_dealt")
