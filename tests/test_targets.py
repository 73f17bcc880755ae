import re
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion.operators.cdc import END_AT, START_AT, CdcSpec, build_target, scd2, slice_of, splice, versions
from medallion.streaming.changelog import commits, compact, read_changes, start_changes, target_view
from medallion.streaming.targets import BUCKET, read_target, refresh_target

DDL = "id bigint, k string, seq bigint, v string"
TYPE1 = CdcSpec("type1", ["k", "v"], ["k"], "seq", tie_break=["id"])
TYPE2 = CdcSpec("type2", ["k", "v"], ["k"], "seq", scd_type=2)
SPECS = [TYPE1, TYPE2, CdcSpec("collapsed", ["k", "v"], ["k"], "seq", scd_type=2, collapse=True)]


def land(spark, path, data):
    spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(f"{path}/in")


def log_new(spark, path, spec, checkpoint="cp"):
    arriving = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    start_changes(arriving, spec, f"{path}/log", f"{path}/{checkpoint}").awaitTermination()


def refresh(spark, path, spec):
    return refresh_target(spark, f"{path}/log", spec, f"{path}/target")


def target(spark, path, spec):
    return read_target(spark, f"{path}/log", spec, f"{path}/target")


def files(path):
    return {str(f) for f in Path(f"{path}/target/state").rglob("*.parquet")}


def changes(count, start=0):
    return [(i, f"k{i % 7}", (i * 37) % 101, f"v{i}") for i in range(start, start + count)]


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
def test_batches_in_any_order_reach_the_batch_result(spark, tmp_path, spec):
    data = [*changes(60), (99, None, 1, "x"), (98, "k1", None, "x")]
    for part in range(4):
        land(spark, tmp_path, data[part::4])
        log_new(spark, tmp_path, spec)
        assert refresh(spark, tmp_path, spec) > 0
        if part == 1:
            compact(spark, f"{tmp_path}/log", spec)
    expected = build_target(spark.createDataFrame(data, DDL), spec)
    assert rows(target(spark, tmp_path, spec)) == rows(expected)
    assert target(spark, tmp_path, spec).columns == expected.columns


@pytest.mark.parametrize("spec", [TYPE1, TYPE2], ids=lambda s: s.name)
def test_other_buckets_keep_their_files(spark, tmp_path, spec):
    land(spark, tmp_path, changes(60))
    log_new(spark, tmp_path, spec)
    refresh(spark, tmp_path, spec)
    before = files(tmp_path)
    assert len({re.search(rf"{BUCKET}=(\d+)", f).group(1) for f in before}) > 2
    log_new(spark, tmp_path, spec)
    assert refresh(spark, tmp_path, spec) == 0 and files(tmp_path) == before
    land(spark, tmp_path, [(500, "k3", 1000, "later")])
    log_new(spark, tmp_path, spec)
    assert refresh(spark, tmp_path, spec) == 1
    changed = {re.search(rf"{BUCKET}=(\d+)", f).group(1) for f in before ^ files(tmp_path)}
    assert len(changed) == 1 and files(tmp_path) & before
    assert ("k3", "later") in [r[:2] for r in rows(target(spark, tmp_path, spec))]


def test_a_lost_checkpoint_after_compaction_neither_loses_nor_doubles(spark, tmp_path):
    for spec in (TYPE1, TYPE2):
        path = tmp_path / spec.name
        land(spark, path, changes(30))
        land(spark, path, changes(10, 30))
        log_new(spark, path, spec)
        compact(spark, f"{path}/log", spec)
        refresh(spark, path, spec)
        land(spark, path, changes(20, 40))
        log_new(spark, path, spec, "another")  # all files again, as batches 0 to 2
        assert sorted(commits(spark, f"{path}/log").values()) == [1, 2]
        refresh(spark, path, spec)
        expected = rows(build_target(spark.createDataFrame(changes(60), DDL), spec))
        assert rows(target(spark, path, spec)) == expected
        assert rows(target_view(spark, f"{path}/log", spec)) == expected
        assert compact(spark, f"{path}/log", spec) is not None
        assert compact(spark, f"{path}/log", spec) is None
        assert rows(target_view(spark, f"{path}/log", spec)) == expected


def test_a_batch_without_its_entry_does_not_count(spark, tmp_path):
    land(spark, tmp_path, changes(10))
    log_new(spark, tmp_path, TYPE1)
    half = f"{tmp_path}/log/changes/__generation=other/__batch=0"
    spark.createDataFrame([("k0", "bad", 10**6, 1)], "k string, v string, seq bigint, id bigint").write.parquet(half)
    assert read_changes(spark, f"{tmp_path}/log").count() == 10


def test_a_refresh_cut_short_is_made_good(spark, tmp_path, monkeypatch):
    from medallion.streaming import targets

    land(spark, tmp_path, changes(30))
    log_new(spark, tmp_path, TYPE2)
    refresh(spark, tmp_path, TYPE2)
    land(spark, tmp_path, changes(30, 30))
    log_new(spark, tmp_path, TYPE2)
    real = targets._write

    def broken(state, spec, path, buckets, mode):
        some = state.where("k = 'k1'")  # as if the other buckets had been taken away
        real(some, spec, path, buckets, "static")
        raise RuntimeError("executor lost")

    monkeypatch.setattr(targets, "_write", broken)
    with pytest.raises(RuntimeError):
        refresh(spark, tmp_path, TYPE2)
    monkeypatch.setattr(targets, "_write", real)
    refresh(spark, tmp_path, TYPE2)
    assert rows(target(spark, tmp_path, TYPE2)) == rows(build_target(spark.createDataFrame(changes(60), DDL), TYPE2))


def test_an_empty_log_gives_an_empty_target(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for spec in (TYPE1, TYPE2):
        path = tmp_path / spec.name
        (path / "in").mkdir(parents=True)
        log_new(spark, path, spec)
        refresh(spark, path, spec)
        assert refresh(spark, path, spec) == 0
        assert target(spark, path, spec).count() == 0
        land(spark, path, changes(5))
        log_new(spark, path, spec)
        refresh(spark, path, spec)
        assert target(spark, path, spec).count() == 5


change = st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", "c", None]), st.integers(0, 9000), st.sampled_from(["x", "y", None]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(before=st.lists(change, max_size=20), after=st.lists(change, max_size=8))
def test_splice_equals_the_whole_history(spark, before, after):
    stored = scd2(spark.createDataFrame(before, DDL), ["k"], "seq").drop(START_AT)
    spliced = splice(stored, spark.createDataFrame(after, DDL), ["k"], "seq")
    expected = scd2(spark.createDataFrame([*before, *after], DDL), ["k"], "seq").drop(START_AT)
    assert rows(spliced.select(*expected.columns)) == rows(expected)


def test_splice_leaves_versions_outside_the_changes_as_they_are(spark):
    """Ends that a recomputation would correct stay where no change reaches them."""
    kept = [(1, "a", 10, "v", -1), (2, "a", 20, "v", 40), (3, "a", 40, "v", -3), (4, "b", 5, "v", -4)]
    stored = spark.createDataFrame(kept, f"{DDL}, {END_AT} bigint")
    out = splice(stored, spark.createDataFrame([(9, "a", 30, "new")], DDL), ["k"], "seq")
    assert rows(out.select("k", "seq", END_AT)) == [("a", 10, -1), ("a", 20, 30), ("a", 30, 40), ("a", 40, -3), ("b", 5, -4)]


@pytest.mark.parametrize("values", [
    [-5000, -1, 0, 4095, 4096, 10**12],
    [datetime(1969, 12, 31, 23, 59), datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 59), datetime(2024, 1, 1, 1)],
    [date(1969, 12, 31), date(2024, 1, 1), date(2024, 1, 31), date(2024, 2, 1)],
    [float("-inf"), -1e300, -1.5, 0.0, 0.25, 3.5, 1e300, float("inf"), float("nan")],
    [Decimal("-1.50"), Decimal("0.10"), Decimal("7.00")],
    ["", "2024-01-01T00:10", "2024-01-01T00:20", "2024-01-01T01", "z"],
    [False, True],
], ids=["whole", "time", "date", "double", "decimal", "text", "boolean"])
def test_slices_follow_the_sequence(spark, values):
    df = spark.createDataFrame([(v, "a") for v in values], "s {}, k string".format(
        {int: "bigint", datetime: "timestamp", date: "date", float: "double", Decimal: "decimal(5,2)", str: "string", bool: "boolean"}[type(values[0])]
    ))
    slices = [r[0] for r in df.withColumn("x", slice_of(df, "s")).orderBy("s").select("x").collect()]
    assert slices == sorted(slices)
    history = scd2(df, ["k"], "s").orderBy(START_AT).select(START_AT, END_AT).collect()
    assert [str(r[1]) for r in history[:-1]] == [str(r[0]) for r in history[1:]] and history[-1][1] is None


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_history_shuffles_rows_once_and_slice_ends_again(spark, tmp_path):
    hot = [(i, "hot" if i % 3 == 0 else f"k{i}", i * 50, "v") for i in range(3000)]
    spark.createDataFrame(hot, DDL).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    plan = executed(scd2(df, ["k"], "seq"))
    assert len(re.findall(r"- Exchange hashpartitioning", plan)) == 2 and "rangepartitioning" not in plan
    collapsed = scd2(df, ["k"], "seq", collapse=True)
    assert "HashAggregate" in executed(collapsed) and rows(collapsed) == rows(scd2(df, ["k"], "seq"))
    merged = versions(df.drop("id"), ["k"], "seq", collapse=True)
    assert "HashAggregate" in executed(merged)


def test_times_hours_apart_meet_across_slices(spark):
    start = datetime(2024, 1, 1)
    data = [("a", start + timedelta(minutes=25 * i)) for i in range(60)]
    out = scd2(spark.createDataFrame(data, "k string, t timestamp"), ["k"], "t").orderBy("t").collect()
    assert [r[END_AT] for r in out] == [t for _, t in data[1:]] + [None]
