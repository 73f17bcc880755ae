"""The same results as SQL over the given tables."""

from __future__ import annotations

from medallion.operators.cdc import CdcSpec
from medallion.plans.rides import DIM_SPECS, FACT_SPEC, STAR_SPECS, LOOKUP_ROWS, STAR_KEYS
from medallion.schemas import LOOKUPS, RIDE
from workloads.inputs import RIDE_SQL

_GEOGRAPHY = (
    "select c.c_custkey, c.c_name, n.n_name as nation, r.r_name as region from customer c "
    "left join nation n on c.c_nationkey = n.n_nationkey "
    "left join region r on n.n_regionkey = r.r_regionkey"
)

_SCD1_LATEST = (
    "select user_id, event_id, event_type, value, ts from (select *, row_number() over "
    "(partition by user_id order by ts desc, event_id desc) rn from events) where rn = 1"
)

_SCD1_COMPOSITE = (
    "select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice from "
    "(select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, "
    "l_partkey desc, l_suppkey desc, l_extendedprice desc) rn from lineitem) where rn = 1"
)

_SCD2 = (
    'select user_id, event_type, ts as "__START_AT", '
    'lead(ts) over (partition by user_id order by ts) as "__END_AT" from events'
)

_FLOWS = (
    "select event_id, user_id, value from events where event_type = 'purchase' union all "
    "select event_id, user_id, value from events where event_type <> 'purchase'"
)

_PRECISE = """
with a as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey,
    round(cast(l_quantity as decimal(12,4)) * cast(1.755 as decimal(6,3)), 2) as df,
    round(cast(l_linenumber as decimal(12,4)) * cast(0.355 as decimal(6,3)), 2) as tf,
    cast(1.005 + l_discount as decimal(9,6)) as surge, cast(l_tax as decimal(9,6)) as tip
  from lineitem),
b as (
  select *, round(cast(df + tf + cast(15000.125 as decimal(12,3)) as decimal(16,4)) * surge, 2) as st from a)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(df as double) as distance_fare,
  cast(tf as double) as time_fare, cast(st as double) as subtotal,
  cast(round(st + tip, 2) as double) as total_fare
from b
"""

_FARES = """
with a as (
  select l_orderkey, l_partkey, l_shipdate, l_extendedprice,
    cast(round(cast(l_quantity as decimal(12,4)) * cast(1.75 as decimal(6,2)), 2) as decimal(12,2)) as df,
    cast(round(cast(l_linenumber as decimal(12,4)) * cast(0.35 as decimal(6,2)), 2) as decimal(12,2)) as tf,
    cast(1 + l_discount as decimal(6,2)) as surge,
    cast(l_tax as decimal(6,2)) as tip
  from lineitem),
b as (
  select *, cast(round((df + tf + cast(2.50 as decimal(6,2))) * surge, 2) as decimal(12,2)) as st
  from a)
select l_orderkey, l_partkey, l_shipdate, l_extendedprice, cast(df as double) as distance_fare,
  cast(tf as double) as time_fare, cast(st as double) as subtotal, cast(st + tip as double) as total_fare
from b
"""

TABLE_ORACLES: dict[str, str] = {
    "decode_value": "select event_id, props as payload from events",
    "parse_json": "select cast(json_extract_string(props, '$.k') as bigint) as k, event_id from events",
    "cast_event_time": "select event_id, ts from events",
    "parse_quarantine": (
        "select event_id, case when event_id % 7 <> 0 then "
        "json_extract_string(props, '$.k') end as k, event_id % 7 = 0 as bad from events"
    ),
    "append_flows": _FLOWS,
    "reconcile_counts": (
        "select (select count(*) from events where event_type = 'purchase') as bulk, "
        "(select count(*) from events where event_type <> 'purchase') as live, "
        "(select count(*) from events) as staged, true as ok"
    ),
    "count_rows": "select count(*) as n from events",
    "enrich_left": _GEOGRAPHY,
    "enrich_where": _GEOGRAPHY + " where c.c_acctbal > 0 and r.r_name = 'AFRICA'",
    "enrich_null_fk": (
        "select c.c_custkey, n.n_name as nation from customer c left join "
        "(select * from nation where n_regionkey <> 0) n on c.c_nationkey = n.n_nationkey"
    ),
    "project_dims": "select distinct c_custkey, c_name, c_mktsegment from customer",
    "dedup_first": (
        "select user_id, event_id, ts from (select *, row_number() over "
        "(partition by user_id order by ts, event_id) rn from events) where rn = 1"
    ),
    "dedup_composite": (
        "select user_id, event_type, event_id from (select *, row_number() over "
        "(partition by user_id, event_type order by ts, event_id) rn from events) where rn = 1"
    ),
    "scd1_latest": _SCD1_LATEST,
    "scd1_self_seq": (
        "select o_orderkey, o_custkey, o_orderdate from (select *, row_number() over "
        "(partition by o_orderkey order by o_orderkey desc, o_orderdate desc, o_custkey desc) rn "
        "from orders) where rn = 1"
    ),
    "scd1_composite": _SCD1_COMPOSITE,
    "scd2_history": _SCD2,
    "scd2_current": f'select user_id, event_type, "__START_AT" from ({_SCD2}) where "__END_AT" is null',
    "scd2_listing": f'select * from ({_SCD2}) order by user_id, "__START_AT"',
    "latest_raw": "select event_id, ts, props from events order by ts desc, event_id desc limit 20",
    "fare_components": _FARES,
    "fare_precise": _PRECISE,
    "trip_timeline": (
        "select o_orderkey, o_orderdate as pickup, o_orderdate + to_minutes(o_orderkey % 120) as dropoff, "
        "o_orderdate - to_minutes(o_orderkey % 10 + 1) as booking from orders"
    ),
    "flatten_text": (
        "select doc_id, replace(text, chr(10), ', ') as text, "
        "concat(upper(substr(lang, 1, 1)), lower(substr(lang, 2))) as lang from documents"
    ),
    "label_to_id": (
        "select e.event_id, cast(coalesce(m.id, 4) as bigint) as type_id from events e left join "
        "(values ('view', 1), ('click', 2), ('purchase', 3)) m(label, id) on e.event_type = m.label"
    ),
    "to_json_event": "select * from events",
    "capture_unwrap": "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "json_array_scan": "select c_custkey, c_name, c_acctbal from customer",
    "full_refresh": "select o_orderkey, o_orderdate, o_totalprice from orders",
    "manifest_copy": (
        "select event_id, ts as at, case when event_id % 3 <> 0 then event_type end as note, "
        "cast(3 as bigint) as fields from events"
    ),
    "manifest_ingest": (
        "select 'customer' as file, count(*) as n, 'Succeeded' as status from customer union all "
        "select 'part', count(*), 'Succeeded' from part union all "
        "select 'supplier', count(*), 'Succeeded' from supplier"
    ),
    "star_readback": (
        f"with fact as ({_SCD1_COMPOSITE}) select f.l_orderkey, f.l_linenumber, f.l_extendedprice, "
        "o.o_orderdate, c.c_name, n.n_name from fact f left join orders o on f.l_orderkey = o.o_orderkey "
        "left join customer c on o.o_custkey = c.c_custkey "
        "left join nation n on c.c_nationkey = n.n_nationkey"
    ),
    "quality_report": (
        "select count(*) as n, count(*) filter (where n.n_nationkey is null) as orphan_fk from customer c "
        "left join (select * from nation where n_regionkey <> 0) n on c.c_nationkey = n.n_nationkey"
    ),
    "duplicate_keys": (
        "select l_orderkey, l_linenumber, count(*) as n from lineitem "
        "group by l_orderkey, l_linenumber having count(*) > 1"
    ),
    "stream_append": _FLOWS,
    "stream_obt": (
        "select e.event_id, e.ts, e.user_id, c.c_name, c.c_mktsegment from events e "
        "left join customer c on e.user_id = c.c_custkey"
    ),
    "stream_lookup_refresh": (
        "with e as (select event_id, cast(case when event_id % 3 = 0 then 1 else user_id end as bigint) as user_id from events) "
        "select e.event_id, e.user_id, c.c_name from e "
        "left join customer c on e.user_id = c.c_custkey and c.c_custkey % 4 <= e.event_id % 4"
    ),
    "stream_late_aside": (
        "with reached as (select event_id % 5 as part, max(ts) as latest from events group by 1) "
        "select event_id, coalesce(ts < (select max(latest) from reached where part < event_id % 5) - interval 3 minutes, false) "
        "as is_late from events"
    ),
    "stream_dedup": "select distinct user_id from events",
    "stream_first_seen": (
        "select user_id, event_type, event_id, ts, value from events "
        "qualify row_number() over (partition by user_id, event_type order by ts, event_id) = 1"
    ),
    "stream_dedup_bounded": "select distinct event_id from events",
    "stream_scd1": _SCD1_LATEST,
    "stream_scd2": _SCD2,
    "stream_scd2_late": _SCD2,
}


def _literal(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, str):
        return f"'{value}'"
    return f"timestamp '{value:%Y-%m-%d %H:%M:%S.%f}'"


_SQL_TYPES = {"timestamp": "timestamp", "bigint": "bigint", "double": "double"}


def _lookup_cte(name: str) -> str:
    """A lookup's rows as a typed common table."""
    fields = LOOKUPS[name].fields
    rows = ", ".join(f"({', '.join(_literal(v) for v in row)})" for row in LOOKUP_ROWS[name])
    typed = ", ".join(
        f"cast({f.name} as {_SQL_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())}) as {f.name}"
        for f in fields
    )
    names = ", ".join(f.name for f in fields)
    return f"{name} as (select {typed} from (values {rows}) t({names}))"


def _rides_ctes() -> list[str]:
    """Rides from order lines; times and fares follow the plain columns."""
    plain = ", ".join(f"{sql} as {name}" for name, sql in RIDE_SQL.items())
    lines = (
        f"lines as (select {plain}, o_orderdate + to_minutes(l_linenumber) as pickup, l_partkey as pk "
        "from lineitem join orders on l_orderkey = o_orderkey)"
    )
    money = (
        "money as (select *, "
        "cast(round(cast(distance_miles as decimal(12,4)) * cast(1.75 as decimal(6,2)), 2) as decimal(12,2)) as df, "
        "cast(round(cast(duration_minutes as decimal(12,4)) * cast(0.35 as decimal(6,2)), 2) as decimal(12,2)) as tf "
        "from lines)"
    )
    sums = (
        "sums as (select *, cast(round((df + tf + cast(base_fare as decimal(6,2))) * "
        "cast(surge_multiplier as decimal(6,2)), 2) as decimal(12,2)) as st from money)"
    )
    derived = {
        "booking_timestamp": "pickup - to_minutes(pk % 10 + 1)",
        "pickup_timestamp": "strftime(pickup, '%Y-%m-%dT%H:%M:%S')",
        "dropoff_timestamp": "strftime(pickup + to_minutes(5 + pk % 116), '%Y-%m-%dT%H:%M:%S')",
        "distance_fare": "cast(df as double)",
        "time_fare": "cast(tf as double)",
        "subtotal": "cast(st as double)",
        "total_fare": "cast(st + cast(tip_amount as decimal(12,2)) as double)",
    }
    columns = ", ".join(f"{derived[c]} as {c}" if c in derived else c for c in RIDE.names)
    return [lines, money, sums, f"rides as (select {columns} from sums)"]


def _obt_ctes() -> list[str]:
    base = ", ".join(f"r.{c}" for c in RIDE.names)
    wide = (
        f"obt as (select {base}, map_vehicle_makes.vehicle_make, map_vehicle_types.vehicle_type, "
        "map_vehicle_types.description, map_vehicle_types.base_rate, map_vehicle_types.per_km, "
        "map_vehicle_types.per_minute, map_ride_statuses.ride_status, map_payment_methods.payment_method, "
        "map_payment_methods.is_card, map_payment_methods.requires_auth, map_cities.city as pickup_city, "
        "map_cities.state, map_cities.region, map_cities.updated_at as city_updated_at, "
        "map_cancellation_reasons.cancellation_reason from rides r "
        "left join map_vehicle_makes on r.vehicle_make_id = map_vehicle_makes.vehicle_make_id "
        "left join map_vehicle_types on r.vehicle_type_id = map_vehicle_types.vehicle_type_id "
        "left join map_ride_statuses on r.ride_status_id = map_ride_statuses.ride_status_id "
        "left join map_payment_methods on r.payment_method_id = map_payment_methods.payment_method_id "
        "left join map_cities on r.pickup_city_id = map_cities.city_id "
        "left join map_cancellation_reasons on "
        "r.cancellation_reason_id = map_cancellation_reasons.cancellation_reason_id)"
    )
    return [*_rides_ctes(), *(_lookup_cte(name) for name in LOOKUPS), wide]


def _first(spec: CdcSpec) -> str:
    """Earliest booking per key, then the smallest remaining columns."""
    rest = [c for c in spec.columns if c not in spec.keys and c != "booking_timestamp"]
    order = ", ".join(f"{c} asc nulls last" for c in ["booking_timestamp", *rest])
    return _ranked(spec, order)


def _latest(spec: CdcSpec) -> str:
    rest = [c for c in spec.columns if c not in spec.keys and c != "booking_timestamp"]
    order = ", ".join(f"{c} desc nulls last" for c in ["booking_timestamp", *rest])
    return _ranked(spec, order)


def _ranked(spec: CdcSpec, order: str) -> str:
    keys = ", ".join(spec.keys)
    present = " and ".join(f"{k} is not null" for k in spec.keys)
    columns = ", ".join(spec.columns)
    return (
        f"select {columns} from (select *, row_number() over (partition by {keys} order by {order}) rn "
        f"from obt where {present}) where rn = 1"
    )


_LOCATION = (
    "select *, city_updated_at as \"__START_AT\", lead(city_updated_at) over "
    "(partition by pickup_city_id order by city_updated_at) as \"__END_AT\" from "
    "(select distinct pickup_city_id, pickup_city, city_updated_at, region, state from obt "
    "where pickup_city_id is not null and city_updated_at is not null)"
)


def _targets() -> dict[str, str]:
    firsts = {s.name: _first(s) for s in DIM_SPECS if s.scd_type == 1}
    return {**firsts, "dim_location": _LOCATION, "fact": _latest(FACT_SPEC)}


def _with(ctes: list[str], body: str) -> str:
    return f"with {', '.join(ctes)} {body}"


def _star() -> str:
    """The fact left-joined with every dimension; shared keys appear once."""
    ctes = _obt_ctes() + [f"{name} as ({sql})" for name, sql in _targets().items()]
    shown = [f"fact.{c}" for c in FACT_SPEC.columns]
    joins = []
    for name, key in STAR_KEYS:
        spec = next(s for s in DIM_SPECS if s.name == name)
        shown += [f"{name}.{c}" for c in spec.columns if c != key]
        is_current = f' and {name}."__END_AT" is null' if spec.scd_type == 2 else ""
        joins.append(f"left join {name} on fact.{key} = {name}.{key}{is_current}")
    return _with(ctes, f"select {', '.join(shown)} from fact {' '.join(joins)}")


_QUALITY = """
select count(*) as n,
  count(*) filter (where not abs(subtotal - (distance_fare + time_fare + base_fare) * surge_multiplier) <= 0.010000001)
    as bad_subtotal,
  count(*) filter (where not abs(total_fare - (subtotal + tip_amount)) <= 0.010000001) as bad_total,
  count(*) filter (where not booking_timestamp <= cast(pickup_timestamp as timestamp)) as bad_booking_time,
  count(*) filter (where not cast(pickup_timestamp as timestamp) <= cast(dropoff_timestamp as timestamp))
    as bad_dropoff_time,
  count(*) filter (where not ((ride_status_id = 1) = (cancellation_reason_id = 4))) as bad_cancellation
from rides
"""


def _reconciled() -> str:
    """Per stored table, rows of its source with and without key and sequence."""
    parts = ["select 'stg_rides' as name, count(*) as received, count(*) as placed, 0 as unplaced, true as ok from rides"]
    for spec in STAR_SPECS:
        present = " and ".join(f"{c} is not null" for c in dict.fromkeys([*spec.keys, spec.sequence_by]))
        parts.append(
            f"select '{spec.name}', count(*), count(*) filter (where {present}), "
            f"count(*) filter (where not ({present})), true from obt"
        )
    return " union all ".join(parts)


def oracles() -> dict[str, str]:
    obt = _obt_ctes()
    star = _star()
    return {
        **TABLE_ORACLES,
        "ride_obt": _with(obt, "select * from obt"),
        "manifest_obt": _with(obt, "select * from obt"),
        **{f"ride_{name}": _with(obt, sql) for name, sql in _targets().items()},
        "ride_star": star,
        "ride_catalog": star,
        "ride_reconciled": _with(obt, _reconciled()),
        "stream_star": star,
        "stream_star_increments": star,
        "ride_quality": _with(_rides_ctes(), _QUALITY),
        "ride_unplaced": _with(
            obt,
            "select count(*) as received, count(*) filter (where pickup_city_id is not null and "
            "city_updated_at is not null) as placed, count(*) filter (where pickup_city_id is null or "
            "city_updated_at is null) as unplaced from obt",
        ),
    }
