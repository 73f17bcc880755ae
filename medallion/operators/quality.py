"""Counts, reconciliation and consistency rules as one-row reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.operators.cdc import all_present


def count_rows(df: DataFrame, output: str = "n") -> DataFrame:
    """Global row count."""
    return df.agg(F.count(F.lit(1)).alias(output))


def reconcile_counts(
    inputs: Mapping[str, DataFrame], target: DataFrame, target_name: str = "staged"
) -> DataFrame:
    """Rows per input and in the target, and whether they add up."""
    frames = {**inputs, target_name: target}
    counts = reduce(
        DataFrame.unionByName,
        (count_rows(df).select(F.lit(name).alias("name"), "n") for name, df in frames.items()),
    )
    wide = counts.agg(
        *(F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in frames)
    )
    total = reduce(lambda a, b: a + b, (F.col(name) for name in inputs))
    return wide.withColumn("ok", F.col(target_name) == total)


def rules_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Row count and, per rule, how many rows break it; one pass over ``df``.

    A rule that evaluates to null is not counted as broken.
    """
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(~rule).alias(name) for name, rule in rules.items()),
    )


def fare_rules(tolerance: float = 0.01) -> dict[str, Column]:
    """Fare arithmetic holds within ``tolerance``."""
    slack = F.lit(tolerance) + F.lit(1e-9)
    subtotal = (F.col("distance_fare") + F.col("time_fare") + F.col("base_fare")) * F.col(
        "surge_multiplier"
    )
    return {
        "bad_subtotal": F.abs(F.col("subtotal") - subtotal) <= slack,
        "bad_total": F.abs(F.col("total_fare") - (F.col("subtotal") + F.col("tip_amount"))) <= slack,
    }


def timeline_rules() -> dict[str, Column]:
    """Booking comes before pickup and pickup before drop-off."""
    pickup = F.col("pickup_timestamp").try_cast("timestamp")
    dropoff = F.col("dropoff_timestamp").try_cast("timestamp")
    return {
        "bad_booking_time": F.col("booking_timestamp") <= pickup,
        "bad_dropoff_time": pickup <= dropoff,
    }


def cancellation_rules(completed_status: int = 1, no_reason: int = 4) -> dict[str, Column]:
    """A completed ride has no cancellation reason, and a cancelled one has one."""
    completed = F.col("ride_status_id") == completed_status
    reasonless = F.col("cancellation_reason_id") == no_reason
    return {"bad_cancellation": completed == reasonless}


def orphan_report(
    df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, output: str = "orphan_fk"
) -> DataFrame:
    """Rows whose key has no lookup row.

    Foreign keys are counted first, so the join meets one row per distinct key
    instead of every fact row.
    """
    per_key = df.groupBy(F.col(key).alias("__fk")).agg(F.count(F.lit(1)).alias("__rows"))
    known = lookup.select(F.col(lookup_key).alias("__pk")).distinct()
    joined = per_key.join(known, F.col("__fk") == F.col("__pk"), "left")
    orphan = F.when(F.col("__fk").isNotNull() & F.col("__pk").isNull(), F.col("__rows"))
    zero = F.lit(0).cast("bigint")
    return joined.agg(
        F.coalesce(F.sum("__rows"), zero).alias("n"),
        F.coalesce(F.sum(orphan), zero).alias(output),
    )


def duplicate_keys(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lookup keys that would multiply rows in a join, with their counts."""
    return lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unsequenced_report(df: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """Rows a keyed target cannot place because key or sequence is null."""
    received, placed = F.count(F.lit(1)), F.count_if(all_present([*keys, sequence_by]))
    return df.agg(
        received.alias("received"), placed.alias("placed"), (received - placed).alias("unplaced")
    )
