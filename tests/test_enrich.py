import pyarrow as pa
import pytest
from conftest import rows

from medallion.operators.enrich import Dimension, JoinSpec, enrich, label_to_id, read_back


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 99)], "id bigint, fk bigint")


@pytest.fixture(scope="module")
def colours(spark):
    return spark.createDataFrame([(10, "red", 1), (20, None, 2)], "cid bigint, colour string, g bigint")


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame([(1, "warm")], "gid bigint, name string")


def spec(colours, **more):
    return JoinSpec(colours, "c", "b.fk = c.cid", ["c.colour"], **more)


def test_left_join_keeps_every_row(base, colours):
    out = enrich(base, "b", ["b.id"], [spec(colours)])
    assert rows(out) == [(1, "red"), (2, None), (3, None), (4, None)]


def test_chain_may_use_earlier_alias_and_rename(base, colours, groups):
    specs = [spec(colours), JoinSpec(groups, "g", "c.g = g.gid", ["g.name AS group_name"])]
    out = enrich(base, "b", ["b.id", "b.fk"], specs)
    assert out.columns == ["id", "fk", "colour", "group_name"]
    assert rows(out)[0] == (1, 10, "red", "warm")
    assert [r[3] for r in rows(out)[1:]] == [None] * 3


def test_duplicate_lookup_keys_multiply(spark, base):
    lookup = spark.createDataFrame([(10, "a"), (10, "b")], "cid bigint, colour string")
    out = enrich(base, "b", ["b.id"], [spec(lookup)])
    assert rows(out) == [(1, "a"), (1, "b"), (2, None), (3, None), (4, None)]


def test_lookup_by_table_name(base, colours):
    colours.createOrReplaceTempView("colours_view")
    out = enrich(base, "b", ["b.id"], [JoinSpec("colours_view", "c", "b.fk = c.cid", ["c.colour"])])
    assert out.count() == 4


@pytest.mark.parametrize(
    "first, second, third, expected",
    [
        ("", "", "", [1, 2, 3, 4]),
        ("b.id > 1", "", "", [2, 3, 4]),
        ("", "c.colour = 'red'", "", [1]),
        ("", "", "g.name IS NULL", [2, 3, 4]),
        ("b.id < 4", "c.g IS NOT NULL", "g.name IS NULL", [2]),
        ("b.id = 1 OR b.id = 2", "c.cid = 20 OR c.cid = 99", "", [2]),
    ],
)
def test_predicates_are_a_conjunction(base, colours, groups, first, second, third, expected):
    specs = [spec(colours, where=second), JoinSpec(groups, "g", "c.g = g.gid", [], where=third)]
    out = enrich(base, "b", ["b.id"], specs, where=first)
    assert [r[0] for r in rows(out)] == expected


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_lookup_is_broadcast_without_probe_exchange(spark, base):
    # From Arrow, so that its size is known.
    colours = spark.createDataFrame(pa.table({"cid": [10, 20], "colour": ["red", None], "g": [1, 2]}))
    plan = plan_of(enrich(base, "b", ["b.id"], [spec(colours)]))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_unfit_lookup_is_not_hinted_and_may_be_salted(base, colours):
    plain = enrich(base, "b", ["b.id"], [spec(colours)])
    salted = enrich(base, "b", ["b.id"], [spec(colours, salts=4)])
    assert "hint" not in plain._jdf.queryExecution().analyzed().toString().lower()
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_label_to_id(spark):
    ids = spark.createDataFrame([("x", 1), ("y", 2)], "label string, id bigint")
    df = spark.createDataFrame([("x",), ("z",), (None,)], "kind string")
    assert rows(label_to_id(df, "kind", ids, "label", "id", "kind_id", default=4)) == [
        (None, 4),
        ("x", 1),
        ("z", 4),
    ]
    assert rows(label_to_id(df, "kind", ids, "label", "id", "kind_id"))[2] == ("z", None)


def test_read_back_takes_current_versions_and_hangs_on_earlier_dimensions(spark):
    fact = spark.createDataFrame([(1, "a", 5.0), (2, "b", 6.0), (3, None, 7.0)], "id bigint, k string, amount double")
    history = spark.createDataFrame(
        [("x", "old", 1, 2), ("x", "new", 2, None), ("y", "only", 1, None)],
        "g string, label string, __START_AT bigint, __END_AT bigint",
    )
    groups = spark.createDataFrame([("a", "x"), ("b", "z")], "code string, group string")
    out = read_back(fact, [Dimension(groups, "k", "code"), Dimension(history, "group", "g")])
    assert out.columns == ["id", "k", "amount", "group", "label"]
    assert rows(out) == [(1, "a", 5.0, "x", "new"), (2, "b", 6.0, "z", None), (3, None, 7.0, None, None)]
    assert read_back(fact, []).columns == fact.columns
