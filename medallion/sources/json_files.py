"""JSON-array files and the manifest that lists them."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from medallion.schemas import LOOKUPS, MANIFEST
from medallion.streaming.publish import JSON_OPTIONS

REPORT = "file string, rows bigint, status string, error string"


def read_json_array(
    spark: SparkSession, path: str, schema: StructType | str | None, multi_line: bool = True
) -> DataFrame:
    """Rows of files that hold JSON arrays of objects.

    A file with one array spread over lines is one task's work, so a large set of
    those should come as many files. Files with an array (or object) per line are
    read with ``multi_line=False`` and split like any text. Malformed content
    fails the read instead of yielding null rows.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def load_lookups(
    spark: SparkSession,
    base: str,
    schemas: Mapping[str, StructType] = LOOKUPS,
    suffix: str = ".json",
    multi_line: bool = True,
) -> dict[str, DataFrame]:
    """One DataFrame per named file under ``base``, with declared types.

    Files that a manifest's copy has written hold an object per line (``multi_line=False``).
    """
    return {
        name: read_json_array(spark, f"{base.rstrip('/')}/{name}{suffix}", schema, multi_line)
        for name, schema in schemas.items()
    }


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a manifest file."""
    return read_json_array(spark, path, MANIFEST)


def _copy(
    spark: SparkSession, source: str, target: str, schema: StructType | None, multi_line: bool
) -> int:
    counted = Observation()
    rows = read_json_array(spark, source, schema, multi_line)
    rows = rows.observe(counted, F.count(F.lit(1)).alias("n"))
    rows.write.mode("overwrite").options(**JSON_OPTIONS).json(target)
    return counted.get["n"]


STAGED = "__staged"
FILE = "__file"
BAD = "__bad"
TEXT = "__text"


class _Files:
    """The file system's own listing and renaming, which need no job."""

    def __init__(self, spark: SparkSession) -> None:
        self.paths = spark._jvm.org.apache.hadoop.fs.Path
        self.names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        self.conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        found = self.paths(path)
        system = found.getFileSystem(self.conf)
        return system, system.makeQualified(found)

    def present(self, path: str) -> tuple[str, str] | None:
        """The full name of a file or folder, and as Spark's metadata columns spell it; None if it isn't there."""
        system, full = self._at(path)
        return (full.toString(), _plain(full.toUri().toString())) if system.exists(full) else None

    def put(self, source: str, target: str) -> None:
        """Move a folder to its place, taking that of what was there."""
        system, full = self._at(target)
        system.delete(full, True)
        system.mkdirs(full.getParent())
        if not system.rename(self.paths(source), full):
            raise OSError(f"cannot move {source} to {target}")

    def escaped(self, value: str) -> str:
        """A partition's value as its folder is named."""
        return self.names.escapePathName(value)

    def drop(self, path: str) -> None:
        system, full = self._at(path)
        system.delete(full, True)


def _plain(uri: str) -> str:
    """``file:/x`` and ``file:///x`` are one name."""
    return re.sub("^([^:/]+):///", r"\1:/", uri)


def _lines(
    spark: SparkSession, paths: list[str], sources: DataFrame, schema: StructType | None, multi_line: bool
) -> DataFrame:
    """Every element of the listed files as a line of JSON, with its file; malformed content is marked."""
    reader = spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE")
    if schema is None:
        # Each element keeps the fields it has, whatever the others have.
        whole = reader.option("singleVariantColumn", TEXT).json(paths)
        elements = F.expr(f"explode(coalesce(try_variant_get({TEXT}, '$', 'array<variant>'), array({TEXT})))")
        rows = whole.select("_metadata.file_path", F.when(F.col(TEXT).isNull(), "").alias(BAD), elements.alias(TEXT))
        lines = rows.select("file_path", BAD, F.to_json(TEXT).alias("value"))
    else:
        marked = StructType([*schema.fields, StructField(BAD, StringType())])
        rows = reader.option("columnNameOfCorruptRecord", BAD).schema(marked).json(paths)
        value = F.to_json(F.struct(*(F.col(f"`{n}`") for n in schema.names)), JSON_OPTIONS)
        lines = rows.select("_metadata.file_path", BAD, value.alias("value"))
    full = F.regexp_replace("file_path", "^([^:/]+):///", "$1:/")
    places = F.array(full, F.regexp_replace(full, "/[^/]*$", ""))
    # A source is a file, or a folder of files.
    named = lines.withColumn("source", F.explode(places)).join(sources, "source")
    return named.select(F.col("name").alias(FILE), F.col(BAD).isNotNull().alias(BAD), "value")


def _copy_together(
    spark: SparkSession,
    names: list[tuple[str, tuple[str, str], str]],
    schema: StructType | None,
    multi_line: bool,
    staging: str,
) -> dict[str, int]:
    """Copy files of one schema, given as (name, full names, target), in one scan; rows of those that are whole."""
    files = _Files(spark)
    # From Arrow, Spark makes a local relation and knows it is small: dealt out by file, a large one would be one task's.
    listed = {"name": [name for name, *_ in names], "source": [spelt for _, (_, spelt), _ in names]}
    sources = spark.createDataFrame(pa.table(listed), "name string, source string")
    lines = _lines(spark, [path for _, (path, _), _ in names], sources, schema, multi_line)
    lines.write.mode("overwrite").partitionBy(BAD, FILE).text(staging)
    shape = StructType([StructField("value", StringType()), StructField(BAD, StringType()), StructField(FILE, StringType())])
    counts = spark.read.schema(shape).text(staging).groupBy(FILE).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.col(BAD) == "true").alias("bad")
    ).collect()
    copied = {}
    targets = {name: target for name, _, target in names}
    for row in counts:
        if not row["bad"]:
            files.put(f"{staging}/{BAD}=false/{FILE}={files.escaped(row[FILE])}", targets[row[FILE]])
            copied[row[FILE]] = row["rows"]
    files.drop(staging)
    return copied


def ingest_manifest(
    spark: SparkSession,
    manifest: DataFrame | str,
    source_template: str,
    target_template: str,
    schemas: Mapping[str, StructType] | None = None,
    retries: int = 0,
    retry_interval: float = 30.0,
    parallel: int = 8,
    multi_line: bool = True,
) -> DataFrame:
    """Copy every listed JSON file and report ``file, rows, status, error``.

    Templates name the file as ``{file}``. A manifest that cannot be read raises
    before anything is copied; a listed file that cannot be copied is reported as
    failed and does not stop the others. Files of one schema, and those without one,
    are read in one scan, counted and then moved to their places, so the number of jobs
    does not grow with the manifest. What that leaves (files that are missing, empty or
    malformed) is copied one by one, with retries, which also finds each one's error.
    """
    listed = read_manifest(spark, manifest) if isinstance(manifest, str) else manifest
    names = [row["file"] for row in listed.select("file").toLocalIterator()]
    files, groups = _Files(spark), {}
    for name in dict.fromkeys(names):
        source = files.present(source_template.format(file=name))
        if source is not None:
            schema = (schemas or {}).get(name)
            group = groups.setdefault(schema and schema.json(), (schema, []))
            group[1].append((name, source, target_template.format(file=name)))
    copied: dict[str, int] = {}
    for schema, group in groups.values():
        staging = target_template.format(file=f"{STAGED}-{uuid.uuid4().hex}")
        try:
            copied |= _copy_together(spark, group, schema, multi_line, staging)
        except Exception:  # its files follow one by one, and report their own errors
            files.drop(staging)

    def run(name: str) -> tuple[str, int | None, str, str | None]:
        if name in copied:
            return name, copied[name], "Succeeded", None
        for attempt in range(retries + 1):
            try:
                rows = _copy(
                    spark,
                    source_template.format(file=name),
                    target_template.format(file=name),
                    (schemas or {}).get(name),
                    multi_line,
                )
                return name, rows, "Succeeded", None
            except Exception as error:  # reported per file, never swallowed
                failure = str(error) or repr(error)
                if attempt < retries:
                    time.sleep(retry_interval)
        return name, None, "Failed", failure

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        report = list(pool.map(run, names))
    return spark.createDataFrame(report, REPORT)
