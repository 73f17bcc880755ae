"""Batch queries over the given tables, one per operator."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions.columns import capitalise, fare_columns, flatten_text, trip_timeline
from medallion.operators.cdc import current, dedup_first, scd1, scd2
from medallion.operators.enrich import Dimension, JoinSpec, enrich, label_to_id, read_back
from medallion.operators.flows import append_flows
from medallion.operators.parse import cast_event_time, decode_value, flag_malformed, parse_json
from medallion.operators.quality import (
    count_rows,
    duplicate_keys,
    orphan_report,
    reconcile_counts,
)
from medallion.schemas import LONG, struct
from medallion.session import work_dir
from medallion.sources.events import read_capture
from medallion.sources.json_files import ingest_manifest, read_json_array
from medallion.sources.tables import full_refresh, read_table
from medallion.streaming.publish import JSON_OPTIONS, to_events
from workloads.inputs import table, write_json_array_lines

K = struct(k=LONG)


def decode(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    raw = events.select("event_id", F.col("props").cast("binary").alias("value"))
    return decode_value(raw, "payload").select("event_id", "payload")


def parse(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return parse_json(events, "props", K, keep=["event_id"])


def event_time(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("string").alias("ts"))
    return cast_event_time(events, "ts").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("<"), "props")).otherwise(F.col("props"))
    events = table(spark, sf, "events").withColumn("props", payload)
    return flag_malformed(events, "props", K).select(
        "event_id", F.col("parsed.k").cast("string").alias("k"), "bad"
    )


def _by_type(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf, "events").select("event_id", "user_id", "value", "event_type")
    bulk = events.where("event_type = 'purchase'").drop("event_type")
    live = events.where("event_type <> 'purchase'").drop("event_type")
    return bulk, live.select("value", "user_id", "event_id")


def flows(spark: SparkSession, sf: str) -> DataFrame:
    return append_flows(*_by_type(spark, sf))


def counts_reconciled(spark: SparkSession, sf: str) -> DataFrame:
    bulk, live = _by_type(spark, sf)
    return reconcile_counts({"bulk": bulk, "live": live}, append_flows(bulk, live))


def rows_counted(spark: SparkSession, sf: str) -> DataFrame:
    return count_rows(table(spark, sf, "events"))


def _geography(spark: SparkSession, sf: str, where: tuple[str, str] = ("", "")) -> DataFrame:
    specs = [
        JoinSpec(
            table(spark, sf, "nation"), "n", "c.c_nationkey = n.n_nationkey", ["n.n_name AS nation"]
        ),
        JoinSpec(
            table(spark, sf, "region"),
            "r",
            "n.n_regionkey = r.r_regionkey",
            ["r.r_name AS region"],
            where=where[1],
        ),
    ]
    base = ["c.c_custkey", "c.c_name"]
    return enrich(table(spark, sf, "customer"), "c", base, specs, where=where[0])


def enrich_left(spark: SparkSession, sf: str) -> DataFrame:
    return _geography(spark, sf)


def enrich_where(spark: SparkSession, sf: str) -> DataFrame:
    return _geography(spark, sf, ("c.c_acctbal > 0", "r.r_name = 'AFRICA'"))


def enrich_null_fk(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").where("n_regionkey <> 0")
    spec = JoinSpec(nation, "n", "c.c_nationkey = n.n_nationkey", ["n.n_name AS nation"])
    return enrich(table(spark, sf, "customer"), "c", ["c.c_custkey"], [spec])


def project_dims(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment").distinct()


def first_per_user(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return dedup_first(events, ["user_id"], ["ts", "event_id"])


def first_per_user_and_type(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts")
    return dedup_first(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


def scd1_latest(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return scd1(events, ["user_id"], "ts", tie_break=["event_id"])


def scd1_self_seq(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return scd1(orders, ["o_orderkey"], "o_orderkey", tie_break=["o_orderdate", "o_custkey"])


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return scd1(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


def scd1_composite(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf)


def _history(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_type", "ts")
    return scd2(events, ["user_id"], "ts").drop("ts")


def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf)


def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return current(_history(spark, sf)).drop("__END_AT")


def scd2_listing(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf).orderBy("user_id", "__START_AT")


def latest_raw(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "props")
    return events.orderBy(F.desc("ts"), F.desc("event_id")).limit(20)


def fare_components(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    fares = fare_columns(
        F.col("l_quantity"),
        F.col("l_linenumber"),
        F.lit(1) + F.col("l_discount"),
        F.col("l_tax"),
    )
    return lines.withColumns(fares).select(
        "l_orderkey", "l_partkey", "l_shipdate", "l_extendedprice", *fares
    )


def fare_precise(spark: SparkSession, sf: str) -> DataFrame:
    """Rates of three decimals, a surge of three and a base fare above 10,000."""
    lines = table(spark, sf, "lineitem")
    fares = fare_columns(
        F.col("l_quantity"),
        F.col("l_linenumber"),
        F.lit(1.005) + F.col("l_discount"),
        F.col("l_tax"),
        base="15000.125",
        per_distance="1.755",
        per_minute="0.355",
    )
    return lines.withColumns(fares).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *fares)


def timeline(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    minutes = (F.col("o_orderkey") % 120).cast("int")
    lead = (F.col("o_orderkey") % 10 + 1).cast("int")
    times = trip_timeline(F.col("o_orderdate"), minutes, lead)
    return orders.select(
        "o_orderkey",
        F.col("o_orderdate").alias("pickup"),
        *(value.alias(name) for name, value in times.items()),
    )


def text_flattened(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", flatten_text(F.col("text")).alias("text"), capitalise(F.col("lang")).alias("lang")
    )


def labels_to_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = spark.createDataFrame(pa.table({"label": ["view", "click", "purchase"], "id": [1, 2, 3]}))
    events = table(spark, sf, "events").select("event_id", "event_type")
    encoded = label_to_id(events, "event_type", ids, "label", "id", "type_id", default=4)
    return encoded.select("event_id", "type_id")


def json_events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return parse_json(to_events(events), "value", events.schema)


def capture(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "capture")
    envelope = table(spark, sf, "events").select(
        F.col("props").alias("body"),
        F.col("event_id").cast("string").alias("offset"),
        F.col("event_id").alias("sequenceNumber"),
        F.lit("2025-03-09T04:05:06.789Z").alias("enqueuedTimeUtc"),
        F.lit("0").alias("partitionId"),
    )
    write_json_array_lines(envelope, path, "sequenceNumber")
    events = decode_value(read_capture(spark, path, multi_line=False), "payload")
    return events.select(
        F.col("offset").alias("event_id"), F.from_json("payload", K).k.alias("k")
    )


def json_array_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "json-array")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    write_json_array_lines(customers, path, "c_custkey")
    return read_json_array(spark, path, customers.schema, multi_line=False)


def refreshed(spark: SparkSession, sf: str) -> DataFrame:
    name = f"orders_{uuid.uuid4().hex}"
    path = work_dir(spark, "refresh")
    orders = table(spark, sf, "orders")
    full_refresh(orders.select("o_orderkey", "o_orderstatus"), name, path=path)
    full_refresh(orders.select("o_orderkey", "o_orderdate", "o_totalprice"), name, path=path)
    return read_table(spark, name)


def manifest_ingested(spark: SparkSession, sf: str) -> DataFrame:
    base = work_dir(spark, "manifest")
    keys = {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}
    for name, key in keys.items():
        write_json_array_lines(table(spark, sf, name), f"{base}/source/{name}.json", key)
    manifest = spark.createDataFrame([(n,) for n in keys], "file string")
    report = ingest_manifest(
        spark,
        manifest,
        f"{base}/source/{{file}}.json",
        f"{base}/raw/ingestion/{{file}}.json",
        schemas={n: table(spark, sf, n).schema for n in keys},
        multi_line=False,
    )
    return report.select("file", F.col("rows").alias("n"), "status")


def manifest_copied(spark: SparkSession, sf: str) -> DataFrame:
    """The rows a manifest's copy holds: nulls and microseconds are kept."""
    base = work_dir(spark, "manifest")
    events = table(spark, sf, "events").select(
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("at"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("note"),
    )
    write_json_array_lines(events, f"{base}/source/events.json", "event_id")
    spark.createDataFrame(pa.table({"file": ["events"]})).write.json(f"{base}/manifest")
    ingest_manifest(
        spark,
        f"{base}/manifest",
        f"{base}/source/{{file}}.json",
        f"{base}/raw/{{file}}.json",
        schemas={"events": events.schema},
        multi_line=False,
    )
    copied = spark.read.text(f"{base}/raw/events.json")
    fields = F.size(F.json_object_keys("value")).cast("bigint").alias("fields")
    return copied.select(F.from_json("value", events.schema, JSON_OPTIONS).alias("row"), fields).select("row.*", "fields")


def star_read_back(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    fact = _fact(spark, sf).select("l_orderkey", "l_linenumber", "l_extendedprice")
    wide = read_back(
        fact,
        [
            Dimension(orders, "l_orderkey", "o_orderkey"),
            Dimension(customers, "o_custkey", "c_custkey"),
            Dimension(nations, "c_nationkey", "n_nationkey"),
        ],
    )
    return wide.select("l_orderkey", "l_linenumber", "l_extendedprice", "o_orderdate", "c_name", "n_name")


def quality(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").where("n_regionkey <> 0")
    return orphan_report(table(spark, sf, "customer"), "c_nationkey", nation, "n_nationkey")


def repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


QUERIES = {
    "decode_value": decode,
    "parse_json": parse,
    "cast_event_time": event_time,
    "parse_quarantine": quarantine,
    "append_flows": flows,
    "reconcile_counts": counts_reconciled,
    "count_rows": rows_counted,
    "enrich_left": enrich_left,
    "enrich_where": enrich_where,
    "enrich_null_fk": enrich_null_fk,
    "project_dims": project_dims,
    "dedup_first": first_per_user,
    "dedup_composite": first_per_user_and_type,
    "scd1_latest": scd1_latest,
    "scd1_self_seq": scd1_self_seq,
    "scd1_composite": scd1_composite,
    "scd2_history": scd2_history,
    "scd2_current": scd2_current,
    "scd2_listing": scd2_listing,
    "latest_raw": latest_raw,
    "fare_components": fare_components,
    "fare_precise": fare_precise,
    "trip_timeline": timeline,
    "flatten_text": text_flattened,
    "label_to_id": labels_to_ids,
    "to_json_event": json_events,
    "capture_unwrap": capture,
    "json_array_scan": json_array_scan,
    "full_refresh": refreshed,
    "manifest_ingest": manifest_ingested,
    "manifest_copy": manifest_copied,
    "star_readback": star_read_back,
    "quality_report": quality,
    "duplicate_keys": repeated_keys,
}
