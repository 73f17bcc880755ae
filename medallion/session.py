"""Session defaults and the shared working folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    app: str = "medallion",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators expect.

    AQE stays on (coalescing, skewed joins, broadcast by runtime size), state
    lives in RocksDB so it may outgrow the heap, and timestamps are UTC.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    It lies under the folder the cluster names in ``spark.checkpoint.dir``. Only a
    session whose executors run in the driver (a local test) may leave that unset and
    gets a temporary folder; on a cluster it is an error, as every executor would write
    to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        base = tempfile.mkdtemp(prefix="medallion-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers of executors that lack it, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="medallion-zip-")) / root.name
        context.addPyFile(shutil.make_archive(str(target), "zip", root.parent, root.name))
        _SHIPPED.add(context.applicationId)
