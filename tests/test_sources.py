import json

import pytest
from conftest import rows
from pyspark.sql.types import LongType, StructField, StructType, TimestampNTZType

from medallion.plans.rides import LOOKUP_ROWS, default_lookups
from medallion.operators.parse import decode_value, parse_json
from medallion.schemas import LOOKUPS, RIDE, RIDE_HISTORY, KAFKA_ROW
from medallion.session import work_dir
from medallion.sources.events import kafka_options, read_capture, secret
from medallion.sources.json_files import ingest_manifest, load_lookups, read_json_array, read_manifest
from medallion.sources.tables import Layer, full_refresh, read_table
from medallion.streaming.publish import publish, to_events


def write_json(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(value, indent=1, ensure_ascii=False), encoding="utf-8")
    return str(path)


def test_schema_sizes():
    assert len(RIDE.fields) == len(RIDE_HISTORY.fields) == 43
    assert {k: len(v) for k, v in LOOKUP_ROWS.items()} == {
        "map_vehicle_makes": 7,
        "map_vehicle_types": 5,
        "map_ride_statuses": 2,
        "map_payment_methods": 4,
        "map_cities": 10,
        "map_cancellation_reasons": 4,
    }
    kinds = [f.dataType.simpleString() for f in RIDE.fields]
    assert {k: kinds.count(k) for k in set(kinds)} == {"string": 20, "bigint": 8, "double": 14, "timestamp": 1}


def test_json_array_with_accents_and_nulls(spark, tmp_path):
    path = write_json(tmp_path / "m.json", [{"cancellation_reason_id": 1, "cancellation_reason": "Conductor canceló"}, {"cancellation_reason_id": 4, "cancellation_reason": None}])
    out = read_json_array(spark, path, LOOKUPS["map_cancellation_reasons"])
    assert rows(out) == [(1, "Conductor canceló"), (4, None)]


def test_lookups_by_name_with_declared_types(spark, tmp_path):
    schema = LOOKUPS["map_cities"]
    city = {"city_id": 1, "city": "Málaga", "state": "S", "region": "R", "updated_at": "2026-07-15T18:54:57.136+00:00"}
    write_json(tmp_path / "map_cities.json", [city])
    found = load_lookups(spark, str(tmp_path), {"map_cities": schema})["map_cities"]
    assert found.schema == schema
    ours = default_lookups(spark)["map_cities"]
    assert ours.schema == schema and ours.where("city_id = 6").first()["updated_at"] == found.first()["updated_at"]


def test_malformed_array_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"file": "a"}, {"file": ')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_manifest(spark, str(tmp_path / "bad.json")).collect()


def test_manifest_reports_every_file(spark, tmp_path):
    manifest = write_json(tmp_path / "files.json", [{"file": "a"}, {"file": "missing"}, {"file": "broken"}, {"file": "b"}])
    write_json(tmp_path / "src/a.json", [{"x": 1}, {"x": 2}])
    write_json(tmp_path / "src/b.json", [{"y": "ñ"}])
    (tmp_path / "src/broken.json").write_text("[{")
    report = ingest_manifest(spark, manifest, f"{tmp_path}/src/{{file}}.json", f"{tmp_path}/raw/ingestion/{{file}}.json")
    got = {r["file"]: (r["rows"], r["status"], r["error"] is not None) for r in report.collect()}
    assert got == {
        "a": (2, "Succeeded", False),
        "b": (1, "Succeeded", False),
        "missing": (None, "Failed", True),
        "broken": (None, "Failed", True),
    }
    assert rows(spark.read.json(f"{tmp_path}/raw/ingestion/a.json")) == [(1,), (2,)]


def test_manifest_is_copied_in_a_constant_number_of_jobs(spark, tmp_path, monkeypatch):
    from medallion.sources import json_files

    alone = []
    real = json_files._copy
    monkeypatch.setattr(json_files, "_copy", lambda *a: alone.append(a[1]) or real(*a))
    jobs, names = [], ["a", "b c", "007", "ñ=%", "e"]
    for count in (2, 5):
        manifest = write_json(tmp_path / f"files{count}.json", [{"file": n} for n in names[:count]])
        for i, name in enumerate(names[:count]):
            write_json(tmp_path / f"src/{name}.json", [{"x": j, "only": {name: None}} for j in range(i + 1)])
        group = f"jobs-{count}"
        spark.sparkContext.setJobGroup(group, group)
        report = ingest_manifest(spark, manifest, f"{tmp_path}/src/{{file}}.json", f"{tmp_path}/raw/{{file}}.json", parallel=1)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        assert rows(report.select("file", "rows")) == sorted((n, i + 1) for i, n in enumerate(names[:count]))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] > 0 and not alone
    assert rows(spark.read.text(f"{tmp_path}/raw/b c.json")) == [('{"only":{"b c":null},"x":0}',), ('{"only":{"b c":null},"x":1}',)]
    assert not [p for p in (tmp_path / "raw").iterdir() if "staged" in p.name]


def test_manifest_with_schemas_folders_and_repeats(spark, tmp_path):
    schema = StructType([StructField("x", LongType()), StructField("t", TimestampNTZType())])
    write_json(tmp_path / "src/one.json", [{"x": 1, "t": "2024-01-01T00:00:00.000001"}, {"x": None}])
    write_json(tmp_path / "src/wrong.json", [{"x": "text"}, {"x": 2}])
    write_json(tmp_path / "src/none.json", [])
    for part in range(3):
        write_json(tmp_path / f"src/many.json/part-{part}.json", [{"x": part}])
    names = ["one", "wrong", "none", "many", "one"]
    manifest = spark.createDataFrame([(n,) for n in names], "file string")
    schemas = {n: schema for n in names}
    report = ingest_manifest(spark, manifest, f"{tmp_path}/src/{{file}}.json", f"{tmp_path}/raw/{{file}}.json", schemas)
    assert [(r["file"], r["rows"], r["status"]) for r in report.collect()] == [
        ("one", 2, "Succeeded"), ("wrong", None, "Failed"), ("none", 0, "Succeeded"), ("many", 3, "Succeeded"), ("one", 2, "Succeeded"),
    ]
    assert rows(spark.read.text(f"{tmp_path}/raw/one.json")) == [('{"x":1,"t":"2024-01-01T00:00:00.000001"}',), ('{"x":null,"t":null}',)]
    assert not (tmp_path / "raw/wrong.json/_SUCCESS").exists()


def test_manifest_failure_stops_before_copying(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ingest_manifest(spark, f"{tmp_path}/none.json", "x/{file}", f"{tmp_path}/out/{{file}}")
    assert not (tmp_path / "out").exists()


def test_empty_manifest(spark, tmp_path):
    manifest = write_json(tmp_path / "files.json", [])
    assert ingest_manifest(spark, manifest, "x/{file}", "y/{file}").count() == 0


def test_manifest_retries(spark, tmp_path, monkeypatch):
    from medallion.sources import json_files

    attempts = []

    def flaky(*args):
        attempts.append(args[1])
        if len(attempts) < 3:
            raise OSError("not yet")
        return 5

    monkeypatch.setattr(json_files, "_copy", flaky)
    manifest = spark.createDataFrame([("a",)], "file string")
    report = ingest_manifest(spark, manifest, "{file}", "{file}", retries=2, retry_interval=0)
    assert rows(report) == [("a", 5, "Succeeded", None)] and len(attempts) == 3
    attempts.clear()
    report = ingest_manifest(spark, manifest, "{file}", "{file}", retries=1, retry_interval=0)
    assert rows(report) == [("a", None, "Failed", "not yet")]


def test_capture_has_kafka_columns(spark, tmp_path):
    body = json.dumps({"ride_id": "r1", "tip_amount": 2, "rating": None, "booking_timestamp": "2025-02-03T14:15:16.987654"})
    entry = {"body": body, "offset": "5", "sequenceNumber": 5, "enqueuedTimeUtc": "2025-03-09T04:05:06.789Z", "partitionId": "3"}
    events = read_capture(spark, write_json(tmp_path / "c.json", [entry]))
    assert [(f.name, f.dataType) for f in events.schema] == [(f.name, f.dataType) for f in KAFKA_ROW]
    assert events.first()["partition"] == 3 and events.first()["offset"] == 5
    ride = parse_json(decode_value(events), "rides", RIDE).first()
    assert (ride["ride_id"], ride["tip_amount"], ride["rating"]) == ("r1", 2.0, None)
    assert ride["booking_timestamp"].microsecond == 987654


def test_kafka_options():
    options = kafka_options("ns.example:9093", "topic", "Endpoint=x;Key=y")
    assert options["kafka.bootstrap.servers"] == "ns.example:9093"
    assert options["subscribe"] == "topic"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["maxOffsetsPerTrigger"] == "10000"
    assert options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "true"
    assert options["kafka.request.timeout.ms"] == options["kafka.session.timeout.ms"] == "10000"
    assert 'username="$ConnectionString" password="Endpoint=x;Key=y";' in options["kafka.sasl.jaas.config"]


def test_secret_names_only_the_key(spark):
    spark.conf.set("my.connection", "s3cret")
    assert secret(spark, "my.connection") == "s3cret"
    with pytest.raises(KeyError, match="other.connection"):
        secret(spark, "other.connection")


@pytest.mark.parametrize(
    "layer, table, expected",
    [
        (Layer(), "t", "`t`"),
        (Layer("bronze"), "t", "`bronze`.`t`"),
        (Layer("bronze", "lake"), "t", "`lake`.`bronze`.`t`"),
        (Layer("bronze", "lake"), "silver.t", "`lake`.`silver`.`t`"),
        (Layer("bronze", "lake"), "other.silver.t", "`other`.`silver`.`t`"),
    ],
)
def test_layer_names(layer, table, expected):
    assert layer.name(table) == expected


def test_layer_rejects_four_parts():
    with pytest.raises(ValueError):
        Layer().name("a.b.c.d")


def test_full_refresh_replaces_rows_and_schema(spark, tmp_path):
    name = Layer("default").name("refreshed")
    full_refresh(spark.range(3), name, path=str(tmp_path / "t"))
    out = full_refresh(spark.range(2).selectExpr("id", "id % 2 AS p"), name, path=str(tmp_path / "t"), partition_by=["p"])
    assert out.columns == ["id", "p"] and read_table(spark, name).count() == 2


def test_events_keep_nulls_and_microseconds(spark):
    df = spark.sql("SELECT 1 AS id, CAST(NULL AS DOUBLE) AS rating, timestamp'2025-02-03 14:15:16.987654' AS t")
    assert json.loads(to_events(df).first()["value"]) == {
        "id": 1,
        "rating": None,
        "t": "2025-02-03T14:15:16.987654",
    }
    assert to_events(df, key="id").columns == ["key", "value"]
    back = parse_json(to_events(df), "value", df.schema)
    assert rows(back) == rows(df)


def test_publish_batch_and_stream(spark, tmp_path):
    df = spark.range(3)
    assert publish(df, "text", {"path": f"{tmp_path}/out"}) is None
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id bigint").parquet(f"{tmp_path}/in")
    with pytest.raises(ValueError):
        publish(stream, "text", {"path": f"{tmp_path}/out2"})
    publish(stream, "text", {"path": f"{tmp_path}/out2"}, checkpoint=f"{tmp_path}/cp")
    assert rows(spark.read.text(f"{tmp_path}/out")) == rows(spark.read.text(f"{tmp_path}/out2"))


def test_work_dir_is_fresh_and_shared(spark):
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert a.startswith(base.rstrip("/"))


def test_manifest_reports_an_error_without_text(spark, tmp_path, monkeypatch):
    from medallion.sources import json_files

    def fails(*_):
        raise KeyError()

    monkeypatch.setattr(json_files, "_copy", fails)
    manifest = spark.createDataFrame([("a",)], "file string")
    row = ingest_manifest(spark, manifest, "{file}", "{file}").first()
    assert (row.status, row.error) == ("Failed", "KeyError()")


def test_rows_of_a_copied_file_stay_in_many_tasks(spark, tmp_path, monkeypatch):
    from medallion.sources import json_files

    (tmp_path / "a.json").write_text("".join(f'[{{"k": {n}}}]\n' for n in range(1000)))
    plans, lines = [], json_files._lines

    def watched(*args):
        found = lines(*args)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(json_files, "_lines", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2000")
    manifest = spark.createDataFrame([("a",)], "file string")
    try:
        for schemas in (None, {"a": StructType([StructField("k", LongType())])}):
            places = (f"{tmp_path}/{{file}}.json", f"{tmp_path}/out/{{file}}.json")
            report = ingest_manifest(spark, manifest, *places, schemas=schemas, multi_line=False)
            assert rows(report) == [("a", 1000, "Succeeded", None)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 2 and all("hashpartitioning" not in p for p in plans)
