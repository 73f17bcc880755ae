"""Column expressions for fares, timelines and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The flat tariff of the ride model.
BASE_FARE = "2.50"
RATE_PER_DISTANCE = "1.75"
RATE_PER_MINUTE = "0.35"


def _exact(value: Column | str | float) -> Column:
    """All digits a rate or amount may have; products of two keep all of theirs."""
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("decimal(16,6)")


def _cents(value: Column) -> Column:
    return F.round(value, 2).cast("decimal(14,2)")


def distance_fare(distance: Column, rate: Column | str = RATE_PER_DISTANCE) -> Column:
    """round(distance × rate, 2) as decimal."""
    return _cents(_exact(distance) * _exact(rate))


def time_fare(minutes: Column, rate: Column | str = RATE_PER_MINUTE) -> Column:
    """round(minutes × rate, 2) as decimal."""
    return _cents(_exact(minutes) * _exact(rate))


def subtotal(distance: Column, time: Column, base: Column | str, surge: Column) -> Column:
    """round((distance fare + time fare + base) × surge, 2) as decimal."""
    return _cents((distance + time + _exact(base)) * _exact(surge))


def fare_columns(
    distance: Column,
    minutes: Column,
    surge: Column,
    tip: Column,
    base: Column | str = BASE_FARE,
    per_distance: Column | str = RATE_PER_DISTANCE,
    per_minute: Column | str = RATE_PER_MINUTE,
) -> dict[str, Column]:
    """The four fare amounts as doubles.

    Rates are either constants or columns of a joined rate card. Amounts are
    rounded half up as decimals, so the result does not depend on how a product
    is represented in binary, and handed back as doubles like every other amount.
    """
    by_distance = distance_fare(distance, per_distance)
    by_time = time_fare(minutes, per_minute)
    sub = subtotal(by_distance, by_time, base, surge)
    total = _cents(sub + _exact(tip))
    parts = {
        "distance_fare": by_distance,
        "time_fare": by_time,
        "subtotal": sub,
        "total_fare": total,
    }
    return {name: value.cast("double") for name, value in parts.items()}


def plus_minutes(start: Column, minutes: Column) -> Column:
    """A timestamp moved by whole minutes; a negative count moves it back."""
    return F.timestamp_add("MINUTE", minutes, start)


def trip_timeline(
    pickup: Column, duration_minutes: Column, lead_minutes: Column
) -> dict[str, Column]:
    """Drop-off and booking time, both counted from pickup."""
    return {
        "dropoff": plus_minutes(pickup, duration_minutes),
        "booking": plus_minutes(pickup, -lead_minutes),
    }


def flatten_text(text: Column, separator: str = ", ") -> Column:
    """A multi-line text on one line."""
    return F.replace(text, F.lit("\n"), F.lit(separator))


def capitalise(word: Column) -> Column:
    """First letter upper case, the rest lower case."""
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substr(word, F.lit(2))))
