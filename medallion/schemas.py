"""Declared schemas: the ride event, its lookups, and the envelopes they travel in.

All fields are nullable.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, LONG, DOUBLE = StringType(), LongType(), DoubleType()
INT, BOOL, TIME, BYTES = IntegerType(), BooleanType(), TimestampType(), BinaryType()


def struct(**fields: DataType) -> StructType:
    """A struct of nullable fields in the order given."""
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# 43 fields.
RIDE = struct(
    # identifiers
    ride_id=STRING,
    confirmation_number=STRING,
    passenger_id=STRING,
    driver_id=STRING,
    vehicle_id=STRING,
    pickup_location_id=STRING,
    dropoff_location_id=STRING,
    # foreign keys
    vehicle_type_id=LONG,
    vehicle_make_id=LONG,
    payment_method_id=LONG,
    ride_status_id=LONG,
    pickup_city_id=LONG,
    dropoff_city_id=LONG,
    cancellation_reason_id=LONG,
    # passenger
    passenger_name=STRING,
    passenger_email=STRING,
    passenger_phone=STRING,
    # driver
    driver_name=STRING,
    driver_rating=DOUBLE,
    driver_phone=STRING,
    driver_license=STRING,
    # vehicle
    vehicle_model=STRING,
    vehicle_color=STRING,
    license_plate=STRING,
    # places
    pickup_address=STRING,
    pickup_latitude=DOUBLE,
    pickup_longitude=DOUBLE,
    dropoff_address=STRING,
    dropoff_latitude=DOUBLE,
    dropoff_longitude=DOUBLE,
    # trip; only the booking time is parsed
    distance_miles=DOUBLE,
    duration_minutes=LONG,
    booking_timestamp=TIME,
    pickup_timestamp=STRING,
    dropoff_timestamp=STRING,
    # money
    base_fare=DOUBLE,
    distance_fare=DOUBLE,
    time_fare=DOUBLE,
    surge_multiplier=DOUBLE,
    subtotal=DOUBLE,
    tip_amount=DOUBLE,
    total_fare=DOUBLE,
    # rating
    rating=DOUBLE,
)

# Bulk history differs from the event in one type: its booking time is text.
RIDE_HISTORY = struct(
    **{f.name: STRING if f.name == "booking_timestamp" else f.dataType for f in RIDE.fields}
)

LOOKUPS: dict[str, StructType] = {
    "map_vehicle_makes": struct(vehicle_make_id=LONG, vehicle_make=STRING),
    "map_vehicle_types": struct(
        vehicle_type_id=LONG,
        vehicle_type=STRING,
        description=STRING,
        base_rate=DOUBLE,
        per_km=DOUBLE,
        per_minute=DOUBLE,
    ),
    "map_ride_statuses": struct(ride_status_id=LONG, ride_status=STRING, is_completed=BOOL),
    "map_payment_methods": struct(
        payment_method_id=LONG, payment_method=STRING, is_card=BOOL, requires_auth=BOOL
    ),
    "map_cities": struct(city_id=LONG, city=STRING, state=STRING, region=STRING, updated_at=TIME),
    "map_cancellation_reasons": struct(cancellation_reason_id=LONG, cancellation_reason=STRING),
}

# Columns a Kafka source yields.
KAFKA_ROW = struct(
    key=BYTES,
    value=BYTES,
    topic=STRING,
    partition=INT,
    offset=LONG,
    timestamp=TIME,
    timestampType=INT,
)

# One entry of a captured-events file; ``body`` holds the JSON payload as text.
CAPTURE = struct(
    body=STRING, offset=STRING, sequenceNumber=LONG, enqueuedTimeUtc=TIME, partitionId=STRING
)

MANIFEST = struct(file=STRING)
