from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion.functions.columns import capitalise, fare_columns, flatten_text, trip_timeline

DDL = "km double, minutes bigint, surge double, tip double"


def fares(df, **more):
    columns = fare_columns(F.col("km"), F.col("minutes"), F.col("surge"), F.col("tip"), **more)
    return df.select(*(v.alias(k) for k, v in columns.items()))


def test_known_fare(spark):
    df = spark.createDataFrame([(22.08, 117, 1.01, 2.0)], DDL)
    assert tuple(fares(df).first()) == (38.64, 40.95, 82.91, 84.91)


def test_rate_card(spark):
    df = spark.createDataFrame([(10.0, 10, 1.0, 0.0)], DDL).selectExpr(
        "*", "5.0D AS base_rate", "3.5D AS per_km", "0.6D AS per_minute"
    )
    out = fares(df, base=F.col("base_rate"), per_distance=F.col("per_km"), per_minute=F.col("per_minute"))
    assert tuple(out.first()) == (35.0, 6.0, 46.0, 46.0)


def test_no_digit_is_lost(spark):
    df = spark.createDataFrame([(10.0, 100, 1.125, 0.0)], DDL)
    assert tuple(fares(df, per_distance="1.755", per_minute="0.355").first()) == (17.55, 35.5, 62.49, 62.49)
    assert fares(df, base="15000.005").first()[2] == 16934.07


def test_null_inputs(spark):
    df = spark.createDataFrame([(None, 10, 1.0, 0.0)], DDL)
    assert tuple(fares(df).first()) == (None, 3.5, None, None)


cents = st.integers(0, 5000).map(lambda n: n / 100)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(cents, st.integers(5, 120), st.integers(100, 250).map(lambda n: n / 100), cents), min_size=1, max_size=30))
def test_fares_against_decimal(spark, trips):
    def money(x):
        return x.quantize(Decimal("0.01"), ROUND_HALF_UP)

    def expected(km, minutes, surge, tip):
        d = money(Decimal(str(km)) * Decimal("1.75"))
        t = money(minutes * Decimal("0.35"))
        s = money((d + t + Decimal("2.50")) * Decimal(str(surge)))
        return tuple(map(float, (d, t, s, s + Decimal(str(tip)))))

    got = [tuple(r) for r in fares(spark.createDataFrame(trips, DDL)).collect()]
    assert got == [expected(*trip) for trip in trips]


def test_timeline_keeps_zone_kind(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-03-01 00:02:00.5' AS p, 30 AS m, 5 AS l")
    times = trip_timeline(F.col("p"), F.col("m"), F.col("l"))
    row = df.select(*(v.alias(k) for k, v in times.items())).first()
    assert row["dropoff"] == datetime(2026, 3, 1, 0, 32, 0, 500000)
    assert row["booking"] == datetime(2026, 2, 28, 23, 57, 0, 500000)


def test_text(spark):
    df = spark.createDataFrame([("1 Main St\nTown\n",), (None,)], "t string")
    assert [r[0] for r in df.select(flatten_text(F.col("t"))).collect()] == ["1 Main St, Town, ", None]
    words = spark.createDataFrame([("hELLO wORLD",), ("",), ("é",), (None,)], "t string")
    assert [r[0] for r in words.select(capitalise(F.col("t"))).collect()] == ["Hello world", "", "É", None]
