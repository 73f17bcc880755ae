import pytest
from conftest import rows
from pyspark.sql import functions as F

from medallion.streaming import first_seen
from medallion.streaming.first_seen import BITMAPS, read_first_seen, start_first_seen

DDL = "k string, j bigint, n bigint, v string"


def land(spark, path, data):
    spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(f"{path}/in")


def run(spark, path, checkpoint="cp", **how):
    arriving = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    query = start_first_seen(arriving, ["k", "j"], ["n"], f"{path}/seen", f"{path}/{checkpoint}", **how)
    query.awaitTermination()
    return read_first_seen(spark, f"{path}/seen")


def parts(count):
    """Batches that share keys; a third of all rows have one key, some have none."""
    key = lambda i: "hot" if i % 3 == 0 else None if i % 11 == 0 else f"k{i % 17}"
    return [[(key(i), None if i % 5 == 0 else i % 2, 1000 - i, f"{p}-{i}") for i in range(p * 20, p * 20 + 40)] for p in range(count)]


def expected(batches):
    held = {}
    for batch in batches:
        best = {}
        for row in batch:
            if row[:2] not in best or (row[2], row[3]) < (best[row[:2]][2], best[row[:2]][3]):
                best[row[:2]] = row
        for key, row in best.items():
            held.setdefault(key, row)
    return sorted(held.values(), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


@pytest.mark.parametrize("how", [{}, {"bits": 8, "buckets": 2}], ids=["sparse", "full bitmaps"])
def test_first_arrivals_over_batches_and_restarts(spark, tmp_path, how):
    batches = parts(5)
    for at, batch in enumerate(batches):
        land(spark, tmp_path, batch)
        out = run(spark, tmp_path, **how)
        if at % 2:
            run(spark, tmp_path, **how)  # nothing new
    assert rows(out) == expected(batches)


def test_a_replayed_batch_and_a_lost_checkpoint_let_nothing_through_twice(spark, tmp_path):
    for batch in parts(3):
        land(spark, tmp_path, batch)
        run(spark, tmp_path)
    once = rows(read_first_seen(spark, f"{tmp_path}/seen"))
    assert rows(run(spark, tmp_path, "another")) == once
    (last,) = (tmp_path / "cp" / "commits").glob("2")
    last.unlink()
    (tmp_path / "cp" / "commits" / ".2.crc").unlink(missing_ok=True)
    assert rows(run(spark, tmp_path)) == once


def test_nothing_arrived(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert run(spark, tmp_path).count() == 0
    land(spark, tmp_path, [])
    assert run(spark, tmp_path).count() == 0


def test_bits_are_found_where_they_were_set(spark):
    places = [0, 1, 7, 8, 4095, 32767, 32768, 99999]
    df = spark.createDataFrame([(p,) for p in places], "p bigint")
    maps = df.groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    asked = spark.createDataFrame([(p, p in places) for p in [*places, 2, 15, 32766, 32769, 10**6]], "p bigint, there boolean")
    tested = asked.join(maps, F.bitmap_bucket_number("p") == F.col("b"), "left")
    assert tested.where(first_seen._is_set(F.col("bits"), F.bitmap_bit_position("p")) != F.col("there")).count() == 0


def test_new_keys_read_no_bucket(spark, tmp_path, monkeypatch):
    land(spark, tmp_path, parts(1)[0])
    run(spark, tmp_path)
    read = []
    real = first_seen._read
    monkeypatch.setattr(first_seen, "_read", lambda s, p, schema, b: read.append(schema.names) or real(s, p, schema, b))
    land(spark, tmp_path, [("new", 1, 1, "x")])
    run(spark, tmp_path)
    assert ["k", "j", first_seen.BUCKET] not in read
    land(spark, tmp_path, [("hot", 1, 1, "x"), ("hot", 0, 1, "x")])
    run(spark, tmp_path)
    assert ["k", "j", first_seen.BUCKET] in read
    assert spark.read.schema(BITMAPS).parquet(f"{tmp_path}/seen/bitmaps/*/*").count() >= 2
