"""The ride-booking model as configuration of the general operators."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import ExitStack, contextmanager
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from medallion.operators.cdc import END_AT, START_AT, CdcSpec, build_target
from medallion.operators.dealing import dealt, partitions_of
from medallion.operators.enrich import Dimension, JoinSpec, enrich, read_back
from medallion.schemas import LOOKUPS, RIDE
from medallion.sources.tables import Buckets

_CITIES_UPDATED = datetime(2026, 7, 15, 18, 54, 57, 136000, tzinfo=timezone.utc)

# The rows of the six lookup tables.
LOOKUP_ROWS: dict[str, list[tuple]] = {
    "map_vehicle_makes": [
        (1, "Toyota"),
        (2, "Honda"),
        (3, "Ford"),
        (4, "Chevrolet"),
        (5, "Nissan"),
        (6, "BMW"),
        (7, "Mercedes"),
    ],
    "map_vehicle_types": [
        (1, "X", "Estándar", 2.5, 1.75, 0.35),
        (2, "XL", "Extra Grande", 3.5, 2.25, 0.45),
        (3, "Shared", "Viaje Compartido", 2.0, 1.5, 0.3),
        (4, "Comfort", "Cómodo", 3.0, 2.0, 0.4),
        (5, "Golden", "Premium", 5.0, 3.5, 0.6),
    ],
    "map_ride_statuses": [
        (1, "Completado", True),
        (2, "Cancelado", False),
    ],
    "map_payment_methods": [
        (1, "Tarjeta de Crédito", True, True),
        (2, "Tarjeta de Débito", True, True),
        (3, "Billetera Digital", False, False),
        (4, "Efectivo", False, False),
    ],
    "map_cities": [
        (1, "Madrid", "Comunidad de Madrid", "Centro", _CITIES_UPDATED),
        (2, "Barcelona", "Cataluña", "Este", _CITIES_UPDATED),
        (3, "Valencia", "Comunidad Valenciana", "Este", _CITIES_UPDATED),
        (4, "Sevilla", "Andalucía", "Sur", _CITIES_UPDATED),
        (5, "Zaragoza", "Aragón", "Noreste", _CITIES_UPDATED),
        (6, "Málaga", "Andalucía", "Sur", _CITIES_UPDATED),
        (7, "Murcia", "Región de Murcia", "Sureste", _CITIES_UPDATED),
        (8, "Palma de Mallorca", "Islas Baleares", "Islas", _CITIES_UPDATED),
        (9, "Bilbao", "País Vasco", "Norte", _CITIES_UPDATED),
        (10, "Valladolid", "Castilla y León", "Noroeste", _CITIES_UPDATED),
    ],
    "map_cancellation_reasons": [
        (1, "Conductor canceló"),
        (2, "Pasajero canceló"),
        (3, "No se presentó"),
        (4, None),
    ],
}


def default_lookups(spark: SparkSession) -> dict[str, DataFrame]:
    """The six lookup tables from the values above."""
    lookups = {}
    for name, schema in LOOKUPS.items():
        columns = dict(zip(schema.names, zip(*LOOKUP_ROWS[name])))
        # From Arrow, Spark makes a local relation, whose size its planner knows.
        lookups[name] = spark.createDataFrame(pa.table({c: list(v) for c, v in columns.items()}), schema)
    return lookups


# Table, condition and columns added.
_JOINS = [
    ("map_vehicle_makes", "r.vehicle_make_id = {t}.vehicle_make_id", ["vehicle_make"]),
    (
        "map_vehicle_types",
        "r.vehicle_type_id = {t}.vehicle_type_id",
        ["vehicle_type", "description", "base_rate", "per_km", "per_minute"],
    ),
    ("map_ride_statuses", "r.ride_status_id = {t}.ride_status_id", ["ride_status"]),
    (
        "map_payment_methods",
        "r.payment_method_id = {t}.payment_method_id",
        ["payment_method", "is_card", "requires_auth"],
    ),
    (
        "map_cities",
        "r.pickup_city_id = {t}.city_id",
        ["city AS pickup_city", "state", "region", "updated_at AS city_updated_at"],
    ),
    (
        "map_cancellation_reasons",
        "r.cancellation_reason_id = {t}.cancellation_reason_id",
        ["cancellation_reason"],
    ),
]


def join_specs(lookups: Mapping[str, DataFrame | str]) -> list[JoinSpec]:
    """How each lookup joins the ride, aliased ``r``; lookups are frames or table names."""
    return [
        JoinSpec(lookups[t], t, on.format(t=t), [f"{t}.{c}" for c in added])
        for t, on, added in _JOINS
    ]


def one_big_table(rides: DataFrame, lookups: Mapping[str, DataFrame | str]) -> DataFrame:
    """The 43 ride columns and 15 lookup columns."""
    return enrich(rides, "r", [f"r.{c}" for c in RIDE.names], join_specs(lookups))


# Names, columns and keys of the star's tables.
# The dimensions are sequenced by their own key, so all rows of a key tie and the
# earliest booking decides. A dimension whose attributes repeat on every ride is
# collapsed first; a booking is as fine as the ride itself and is not.
DIM_SPECS: list[CdcSpec] = [
    CdcSpec(
        "dim_passenger",
        ["passenger_id", "passenger_name", "passenger_email", "passenger_phone"],
        ["passenger_id"],
        "passenger_id",
        keep="first",
        collapse=True,
        tie_break=["booking_timestamp"],
    ),
    CdcSpec(
        "dim_driver",
        ["driver_id", "driver_name", "driver_rating", "driver_phone", "driver_license"],
        ["driver_id"],
        "driver_id",
        keep="first",
        collapse=True,
        tie_break=["booking_timestamp"],
    ),
    CdcSpec(
        "dim_vehicle",
        [
            "vehicle_id",
            "vehicle_make_id",
            "vehicle_type_id",
            "vehicle_model",
            "vehicle_color",
            "license_plate",
            "vehicle_make",
            "vehicle_type",
        ],
        ["vehicle_id"],
        "vehicle_id",
        keep="first",
        collapse=True,
        tie_break=["booking_timestamp"],
    ),
    CdcSpec(
        "dim_payment",
        ["payment_method_id", "payment_method", "is_card", "requires_auth"],
        ["payment_method_id"],
        "payment_method_id",
        keep="first",
        collapse=True,
        tie_break=["booking_timestamp"],
    ),
    CdcSpec(
        "dim_booking",
        [
            "ride_id",
            "confirmation_number",
            "dropoff_location_id",
            "ride_status_id",
            "dropoff_city_id",
            "cancellation_reason_id",
            "dropoff_address",
            "dropoff_latitude",
            "dropoff_longitude",
            "booking_timestamp",
            "dropoff_timestamp",
        ],
        ["ride_id"],
        "ride_id",
        keep="first",
        tie_break=["booking_timestamp"],
    ),
    CdcSpec(
        "dim_location",
        ["pickup_city_id", "pickup_city", "city_updated_at", "region", "state"],
        ["pickup_city_id"],
        "city_updated_at",
        scd_type=2,
        collapse=True,
    ),
]

FACT_SPEC = CdcSpec(
    "fact",
    [
        "ride_id",
        "pickup_city_id",
        "payment_method_id",
        "driver_id",
        "passenger_id",
        "vehicle_id",
        "distance_miles",
        "duration_minutes",
        "base_fare",
        "distance_fare",
        "time_fare",
        "surge_multiplier",
        "total_fare",
        "tip_amount",
        "rating",
        "base_rate",
        "per_km",
        "per_minute",
    ],
    [
        "ride_id",
        "pickup_city_id",
        "payment_method_id",
        "driver_id",
        "passenger_id",
        "vehicle_id",
    ],
    "ride_id",
    tie_break=["booking_timestamp"],
)

STAR_SPECS: list[CdcSpec] = [*DIM_SPECS, FACT_SPEC]


def build_star(obt: DataFrame) -> dict[str, DataFrame]:
    """Dimensions and fact from a stored one-big-table, each reading its own columns."""
    return {spec.name: build_target(obt, spec) for spec in STAR_SPECS}


# dimension, key it shares with the fact
STAR_KEYS = [
    ("dim_passenger", "passenger_id"),
    ("dim_driver", "driver_id"),
    ("dim_vehicle", "vehicle_id"),
    ("dim_payment", "payment_method_id"),
    ("dim_location", "pickup_city_id"),
    ("dim_booking", "ride_id"),
]


# Tables as fine as the ride itself, which meet on its id.
FINE = {"fact": ["ride_id"], "dim_booking": ["ride_id"]}


def star_buckets(count: int) -> dict[str, Buckets]:
    """The layout in which the star's two large tables join without a shuffle."""
    return {name: Buckets(count, keys) for name, keys in FINE.items()}


@contextmanager
def dealt_star(obt: DataFrame, root: str, layout: Mapping[str, Buckets]) -> Iterator[dict[str, DataFrame]]:
    """As ``build_star``, to be stored within the block.

    Type 1 tables are dealt out once, through files under ``root``: by their layout, or else by key.
    """
    with ExitStack() as held:
        rows = {}
        for spec in STAR_SPECS:
            if spec.scd_type == 1:
                wanted = layout.get(spec.name, Buckets(partitions_of(obt.sparkSession), spec.keys))
                own = obt.select(*spec.source_columns)
                rows[spec.name] = held.enter_context(dealt(own, spec, wanted.keys, wanted.count, root))
        yield {spec.name: build_target(rows.get(spec.name, obt), spec) for spec in STAR_SPECS}


def star_readback(star: Mapping[str, DataFrame]) -> DataFrame:
    """The fact with its dimensions, locations in their current version.

    The booking, as fine as the fact, comes first: stored in buckets of the ride both join
    where they lie.
    """
    fine_first = sorted(STAR_KEYS, key=lambda d: d[0] not in FINE)
    wide = read_back(star["fact"], [Dimension(star[dim], key) for dim, key in fine_first])
    shown = [c for dim, key in STAR_KEYS for c in star[dim].columns if c not in (key, START_AT, END_AT)]
    return wide.select(*star["fact"].columns, *shown)
