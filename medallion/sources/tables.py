"""Named tables: resolving names, full refresh, published versions, batch and streaming reads."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# How the library's own Parquet files are compressed: payloads and wide rows repeat much of themselves.
CODEC = "zstd"


@dataclass(frozen=True)
class Layer:
    """Where unqualified table names belong. A qualified name is left as it is."""

    schema: str | None = None
    catalog: str | None = None

    def name(self, table: str) -> str:
        parts = table.split(".")
        if len(parts) > 3:
            raise ValueError(f"{table!r} has more than three parts")
        if len(parts) == 1 and self.schema:
            parts = [self.schema, *parts]
        if len(parts) == 2 and self.catalog:
            parts = [self.catalog, *parts]
        return ".".join(f"`{p.strip('`')}`" for p in parts)


def full_refresh(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    path: str | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Replace a table by ``df``, schema included, and return it as stored.

    A table that a stream reads must not be refreshed under it: give the stream
    a new checkpoint and target afterwards.
    """
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


@dataclass(frozen=True)
class Buckets:
    """How a published table is laid out: rows with equal keys in one of ``count`` sorted files.

    Tables with equal buckets join on these keys where they lie.
    """

    count: int
    keys: Sequence[str]


def _write_version(df: DataFrame, name: str, path: str, fmt: str, buckets: Buckets | None) -> None:
    if buckets is not None:
        # In the session's own number, rows that are dealt out by these keys already stay where they are.
        own = buckets.count == int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(*(() if own else (buckets.count,)), *buckets.keys)
    writer = df.write.mode("errorifexists").format(fmt).option("path", path)
    if fmt == "parquet":
        writer = writer.option("compression", CODEC)
    if buckets is not None:
        writer = writer.bucketBy(buckets.count, *buckets.keys).sortBy(*buckets.keys)
    writer.saveAsTable(name)


def _layout(spark: SparkSession, name: str) -> tuple:
    """What must be equal for an entry to be switched to another folder: columns, format and buckets."""
    shown = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    return spark.table(name).schema, *(shown.get(k) for k in ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns"))


def publish_tables(
    frames: Mapping[str, DataFrame],
    layer: Layer,
    root: str,
    buckets: Mapping[str, Buckets] | None = None,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Replace named tables by new versions; returns them as stored.

    Every version is a folder of its own under ``root``. All are complete before the
    first entry of the catalog is switched to its new folder, so a run that fails shows
    nothing, and readers that have begun keep the files they began with. Folders of
    former versions are left for whoever knows that no reader is left.
    """
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    version = uuid.uuid4().hex
    made = {}

    def write(table: str) -> None:
        temporary, path = f"{table}__{version}", f"{root.rstrip('/')}/{table}/{version}"
        made[table] = (layer.name(temporary), path)
        _write_version(frames[table], layer.name(temporary), path, fmt, (buckets or {}).get(table))

    try:
        with ThreadPoolExecutor(max_workers=len(frames)) as pool:
            list(pool.map(write, frames))
        for table, (temporary, path) in made.items():
            # An entry is renamed within its catalog, which its new name leaves out.
            name, short = layer.name(table), Layer(layer.schema).name(table)
            if not spark.catalog.tableExists(name):
                spark.sql(f"ALTER TABLE {temporary} RENAME TO {short}")
            elif _layout(spark, name) == _layout(spark, temporary):
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
                spark.catalog.refreshTable(name)
            else:
                # Other columns or buckets need another entry; the files of both are external and stay.
                spark.sql(f"DROP TABLE {name}")
                spark.sql(f"ALTER TABLE {temporary} RENAME TO {short}")
    finally:
        for temporary, _ in made.values():
            spark.sql(f"DROP TABLE IF EXISTS {temporary}")
    return {table: spark.table(layer.name(table)) for table in frames}


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_table_stream(spark: SparkSession, name: str, max_files: int | None = None) -> DataFrame:
    """A stored table as a stream of the files added to it."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.table(name)
