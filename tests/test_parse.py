from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from medallion.operators.parse import cast_event_time, decode_value, flag_malformed, parse_json
from medallion.schemas import DOUBLE, LONG, STRING, TIME, struct

SCHEMA = struct(a=LONG, b=DOUBLE, s=STRING, t=TIME)

PAYLOADS = {
    "valid": '{"a": 1, "b": 2.5, "s": "x", "t": "2025-02-03T14:15:16.987654"}',
    "no fraction": '{"a": 1, "b": 2.5, "s": "x", "t": "2025-02-03T14:15:16"}',
    "not json": "<oops>",
    "null": None,
    "empty": "",
    "array": '[{"a": 1}]',
    "blank": " \t\n ",
    "text after": '{"a": 1} xyz',
    "two objects": '{"a": 1}{"a": 2}',
    "listed objects": '{"a": 1},{"a": 2}',
    "wrong type": '{"a": "abc", "b": 2.5, "s": "x"}',
    "fraction for int": '{"a": 3.0, "b": 2.5}',
    "int for double": '{"a": 1, "b": 2}',
    "text for double": '{"a": 1, "b": "7"}',
    "unknown field": '{"a": 1, "z": true}',
}


@pytest.fixture(scope="module")
def payloads(spark):
    return spark.createDataFrame(list(PAYLOADS.items()), "name string, p string")


def test_decode_keeps_source_columns(spark):
    df = spark.createDataFrame([(bytearray("añ".encode()), 7)], "value binary, offset bigint")
    out = decode_value(df)
    assert out.columns == ["value", "offset", "rides"]
    assert out.first()["rides"] == "añ"


def test_parse_drops_source_columns(payloads):
    assert parse_json(payloads, "p", SCHEMA).columns == ["a", "b", "s", "t"]


def test_parse_null_row_semantics(payloads):
    parsed = {r["name"]: tuple(r)[1:] for r in parse_json(payloads, "p", SCHEMA, keep=["name"]).collect()}
    nulls = (None,) * 4
    assert parsed["valid"] == (1, 2.5, "x", datetime(2025, 2, 3, 14, 15, 16, 987654))
    assert parsed["no fraction"][3] == datetime(2025, 2, 3, 14, 15, 16)
    for bad in ("not json", "null", "empty", "array"):
        assert parsed[bad] == nulls, bad
    assert parsed["wrong type"] == (None, 2.5, "x", None)
    assert parsed["fraction for int"] == (None, 2.5, None, None)
    assert parsed["int for double"][1] == 2.0
    assert parsed["text for double"] == (1, None, None, None)
    assert parsed["unknown field"] == (1, None, None, None)
    assert len(parsed) == len(PAYLOADS)


def test_quarantine_splits_every_row(payloads):
    good, bad = parse_json(payloads, "p", SCHEMA, mode="quarantine", keep=["name"])
    good_names = {r["name"] for r in good.collect()}
    bad_names = {r["name"] for r in bad.collect()}
    assert bad.columns == payloads.columns
    assert good_names == {"valid", "no fraction", "int for double", "unknown field"}
    assert good_names | bad_names == set(PAYLOADS) and not good_names & bad_names
    dropped = parse_json(payloads, "p", SCHEMA, mode="drop", keep=["name"])
    assert rows(dropped) == rows(good)


def test_flag_parses_once(payloads):
    flagged = flag_malformed(payloads, "p", SCHEMA).select("parsed.a", "parsed.b", "bad")
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    # Once for the fields, once to see that nothing follows the object.
    assert plan.lower().count("from_json") <= 2


def test_unknown_mode(payloads):
    with pytest.raises(ValueError):
        parse_json(payloads, "p", SCHEMA, mode="other")


def test_cast_event_time(spark):
    df = spark.createDataFrame([("2026-01-01T10:00:00",), (None,), ("bad",)], "t string")
    lenient = cast_event_time(df, "t", strict=False)
    assert rows(lenient) == [(None,), (None,), (datetime(2026, 1, 1, 10),)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_event_time(df, "t").collect()
    good = cast_event_time(df.where(F.col("t") != "bad"), "t")
    assert dict(good.dtypes) == {"t": "timestamp"} and good.count() == 1
