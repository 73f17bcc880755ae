"""Working tables in the shared folder, which cut lineage and survive lost executors."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.session import work_dir

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet where every executor can read it, and read back.

    What was shuffled to make it is removed as soon as it is written.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove the files of working tables that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def need(df: DataFrame, *columns: str) -> DataFrame:
    """Just these columns, so that others, whatever their names, play no part."""
    return df.select(*columns)


def text_bytes() -> Column:
    """The whole text as UTF-8 bytes; null stays null."""
    return F.col("text").cast("binary").alias("text")


def texts(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a column one by one, so that only one is copied at a time."""
    for value in column:
        yield value.as_py()


def in_parts(df: DataFrame, name: str, parts: int, *order: str) -> DataFrame:
    """``df`` stored in range partitions of ``order``, each row with its partition's number ``part``.

    Later steps can then order or add up within a part and carry totals from part to
    part, instead of ordering everything in one task.
    """
    dealt = df.repartitionByRange(parts, *order)
    return stored(dealt.withColumn("part", F.spark_partition_id()), name)


def with_running_total(df: DataFrame, amount: str, name: str, *order: str) -> DataFrame:
    """``df`` of ``in_parts`` with the sum of ``amount`` over all rows before each, in order.

    Only one number per part is brought together.
    """
    totals = df.groupBy("part").agg(F.sum(amount).alias("of_part"))
    before = F.sum("of_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = totals.select("part", F.coalesce(before, F.lit(0)).alias("carried"))
    within = F.sum(amount).over(
        Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = df.withColumn(name, F.coalesce(within, F.lit(0))).join(carried, "part")
    return summed.withColumn(name, (F.col(name) + F.col("carried")).cast("long")).drop("carried")
