"""Rows as JSON events on a topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Nulls and microseconds survive, which Spark's JSON defaults do not ensure.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_events(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON text per row in ``value``, keyed by a column if one is named."""
    value = F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def publish(
    df: DataFrame,
    fmt: str,
    options: Mapping[str, str] | None = None,
    key: str | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery | None:
    """Write rows as events: once for a batch, incrementally for a stream."""
    events = to_events(df, key)
    if not df.isStreaming:
        events.write.format(fmt).options(**(options or {})).mode("append").save()
        return None
    if checkpoint is None:
        raise ValueError("publishing a stream needs a checkpoint")
    writer = events.writeStream.format(fmt).options(**(options or {}))
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
