from collections import defaultdict

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from medallion.operators.cdc import (
    CdcSpec,
    apply_changes,
    build_target,
    current,
    dedup_first,
    scd1,
    scd2,
    unsequenced,
    versions,
)

DDL = "k string, seq bigint, v string, w bigint"

EDGE = [
    ("a", 2, "new", 1),
    ("a", 1, "old", 9),  # out of order
    ("b", 1, "x", 1),
    ("b", 1, "y", 1),  # tie
    ("b", 1, None, 5),
    ("c", None, "noseq", 1),
    ("c", 3, "c3", None),
    (None, 1, "nokey", 1),
    ("d", 7, "only", 1),
    ("d", 7, "only", 1),  # copy
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DDL)


def test_scd1_latest(edge):
    assert rows(scd1(edge, ["k"], "seq")) == [
        ("a", 2, "new", 1),
        ("b", 1, "y", 1),
        ("c", 3, "c3", None),
        ("d", 7, "only", 1),
    ]


def test_scd1_tie_break_comes_before_remaining_columns(edge):
    assert ("b", 1, None, 5) in rows(scd1(edge, ["k"], "seq", tie_break=["w"]))


def test_scd1_first_puts_nulls_last(edge):
    assert rows(scd1(edge, ["k"], "seq", keep="first")) == [
        ("a", 1, "old", 9),
        ("b", 1, "x", 1),
        ("c", 3, "c3", None),
        ("d", 7, "only", 1),
    ]


def test_scd1_sequence_is_the_key(edge):
    out = scd1(edge, ["k"], "k", tie_break=["seq"])
    assert ("c", 3, "c3", None) in rows(out) and len(rows(out)) == 4


def test_scd1_key_only(edge):
    assert rows(scd1(edge.select("k"), ["k"], "k")) == [("a",), ("b",), ("c",), ("d",)]


def test_scd1_composite_key(edge):
    assert edge.where("k is not null and v is not null and seq is not null").select("k", "v").distinct().count() == scd1(
        edge, ["k", "v"], "seq"
    ).count()


@pytest.mark.parametrize("keep", ["first", "latest"])
def test_collapse_changes_nothing(edge, keep):
    assert rows(scd1(edge, ["k"], "seq", keep=keep)) == rows(scd1(edge, ["k"], "seq", keep=keep, collapse=True))


def test_unsequenced_is_the_complement(edge):
    left_out = rows(unsequenced(edge, ["k"], "seq"))
    assert left_out == [(None, 1, "nokey", 1), ("c", None, "noseq", 1)]


def test_dedup_keeps_null_key_as_group(edge):
    out = rows(dedup_first(edge, ["k"], ["seq"]))
    assert (None, 1, "nokey", 1) in out and len(out) == 5
    assert ("c", 3, "c3", None) in out  # null order value comes last


def test_dedup_composite(edge):
    assert dedup_first(edge, ["k", "seq"], ["w"]).count() == 7


def test_versions_merge_copies(edge):
    assert rows(versions(edge, ["k"], "seq")) == [
        ("a", 1, "old", 9),
        ("a", 2, "new", 1),
        ("b", 1, "y", 1),
        ("c", 3, "c3", None),
        ("d", 7, "only", 1),
    ]


def test_scd2_history(edge):
    out = scd2(edge, ["k"], "seq")
    assert out.columns == ["k", "seq", "v", "w", "__START_AT", "__END_AT"]
    assert [(r[0], r[4], r[5]) for r in rows(out)] == [
        ("a", 1, 2),
        ("a", 2, None),
        ("b", 1, None),
        ("c", 3, None),
        ("d", 7, None),
    ]
    assert {r[0] for r in rows(current(out))} == {"a", "b", "c", "d"}


def test_late_insert_between_versions(spark):
    early = spark.createDataFrame([("a", 1, "x"), ("a", 9, "z")], "k string, seq bigint, v string")
    late = spark.createDataFrame([("a", 5, "y")], early.schema)
    assert [(r[3], r[4]) for r in rows(scd2(early.union(late), ["k"], "seq"))] == [(1, 5), (5, 9), (9, None)]


def test_apply_changes_dispatch(edge):
    assert rows(apply_changes(edge, ["k"], "seq", 1)) == rows(scd1(edge, ["k"], "seq"))
    assert rows(apply_changes(edge, ["k"], "seq", 2)) == rows(scd2(edge, ["k"], "seq"))
    with pytest.raises(ValueError):
        apply_changes(edge, ["k"], "seq", 3)


def test_build_target_hides_ordering_columns(edge):
    spec = CdcSpec("t", ["k", "v"], ["k"], "k", keep="first", collapse=True, tie_break=["seq"])
    assert rows(build_target(edge, spec)) == [("a", "old"), ("b", "x"), ("c", "c3"), ("d", "only")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_collapse_merges_by_hash_before_the_shuffle(edge):
    spec = CdcSpec("t", ["k", "v"], ["k"], "k", keep="first", collapse=True, tie_break=["seq"])
    plan = plan_of(build_target(edge, spec))
    assert plan.count("HashAggregate") >= 2 and "partial_min(seq" in plan


def test_scd1_reduces_before_the_shuffle(edge):
    assert "partial_max(struct" in plan_of(scd1(edge, ["k"], "seq"))


change = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.one_of(st.none(), st.integers(0, 6)),
    st.sampled_from(["x", "y", None]),
    st.one_of(st.none(), st.integers(0, 3)),
)
quick = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def high(value):
    """Order with nulls lowest, so that descending puts them last."""
    return (value is not None, value if value is not None else 0) if not isinstance(value, str) else (True, value)


def brute_versions(changes):
    best = {}
    for k, seq, v, w in changes:
        if k is None or seq is None:
            continue
        rank = ((v is not None, v or ""), (w is not None, w or 0))
        if (k, seq) not in best or rank > best[k, seq][0]:
            best[k, seq] = (rank, (k, seq, v, w))
    return {key: row for key, (_, row) in best.items()}


@quick
@given(changes=st.lists(change, max_size=25), seed=st.randoms(use_true_random=False))
def test_history_properties(spark, changes, seed):
    shuffled = list(changes)
    seed.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, DDL)
    history = rows(scd2(df, ["k"], "seq"))
    expected = brute_versions(changes)

    assert sorted(r[:4] for r in history) == sorted(expected.values(), key=lambda r: (r[0], r[1]))
    per_key = defaultdict(list)
    for r in history:
        per_key[r[0]].append((r[4], r[5]))
    for spans in per_key.values():
        assert [end for _, end in spans] == [start for start, _ in spans[1:]] + [None]
    assert rows(scd2(df, ["k"], "seq")) == history
    assert rows(scd1(df, ["k"], "seq")) == [r[:4] for r in history if r[5] is None]
