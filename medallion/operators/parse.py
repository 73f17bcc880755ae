"""From payload bytes to typed columns."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def decode_value(df: DataFrame, output: str = "rides", value: str = "value") -> DataFrame:
    """Add the payload as text, keeping every source column."""
    return df.withColumn(output, F.col(value).cast("string"))


def flag_malformed(
    df: DataFrame, column: str, schema: StructType, parsed: str = "parsed", flag: str = "bad"
) -> DataFrame:
    """Parse ``column`` into a struct and say which payloads failed to parse.

    A payload is bad if it is null, blank, anything but one JSON object (another value
    or text after it counts), or has a field of another type.
    """
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    record = F.from_json(F.col(column), with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    fields = F.struct(*(F.col(f"__record.`{f.name}`") for f in schema.fields))
    # As the only member of a list, an object may have nothing after it.
    as_list = F.concat(F.lit("["), F.col(column), F.lit("]"))
    objects = ArrayType(StructType(schema.fields[:1]))
    bad = (
        F.col(column).isNull()
        | ~F.col(column).rlike(r"^\s*\{")
        | (F.coalesce(F.size(F.from_json(as_list, objects)), F.lit(-1)) != 1)
        | F.col(f"__record.{CORRUPT}").isNotNull()
    )
    return (
        df.withColumn("__record", record)
        .withColumn(parsed, fields)
        .withColumn(flag, bad)
        .drop("__record")
    )


def parse_json(
    df: DataFrame,
    column: str,
    schema: StructType,
    mode: Literal["null_row", "drop", "quarantine"] = "null_row",
    keep: Sequence[str] = (),
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Parse a JSON column and keep only the parsed columns, plus those in ``keep``.

    ``null_row`` turns an unparsable payload into a row of nulls. ``drop`` leaves
    such rows out, and ``quarantine`` returns (good rows, bad source rows).
    """
    if mode == "null_row":
        parsed = df.select(*keep, F.from_json(F.col(column), schema).alias("__parsed"))
        return parsed.select(*keep, "__parsed.*")
    flagged = flag_malformed(df, column, schema, "__parsed", "__bad")
    good = flagged.where(~F.col("__bad")).select(*keep, "__parsed.*")
    if mode == "drop":
        return good
    if mode == "quarantine":
        return good, flagged.where("__bad").select(*df.columns)
    raise ValueError(f"unknown mode {mode!r}")


def cast_event_time(df: DataFrame, column: str, strict: bool = True) -> DataFrame:
    """Overwrite a text column by its timestamp.

    ``strict`` leaves a bad value to the session's cast rule (an error under
    ANSI); otherwise it becomes null.
    """
    source = F.col(column)
    value = source.cast("timestamp") if strict else source.try_cast("timestamp")
    return df.withColumn(column, value)
