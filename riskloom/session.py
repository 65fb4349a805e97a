"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

STREAM_SETTINGS = {
    # State on disk and in native memory instead of the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A commit uploads what changed and not the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Most frequent categories take two aggregates, one after the other.
    "spark.sql.streaming.statefulOperator.allowMultiple": "true",
}


def get_spark(app_name: str = "riskloom", options: Mapping[str, str] = {}) -> SparkSession:
    """A session for the command line. The master comes from spark-submit when it is set there."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def utc_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings in UTC: windows align to the epoch in UTC, so hours and
    days are read in UTC as well. The caller's own session stays as it is."""
    session = spark.newSession()
    held = session.conf.getAll  # asked for at once: each setting alone is a call to the JVM
    for key, value in spark.conf.getAll.items():
        if held.get(key) != value and session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session with other values of some settings, which it gets back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def partitions_of(spark: SparkSession) -> int:
    """The configured number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stream_session(spark: SparkSession) -> SparkSession:
    """A session for one stream, in UTC, with its own SQL settings and the same executors.

    The number of shuffle partitions becomes the number of state stores and stays fixed for the
    life of the checkpoint, so size it before the first start.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", partitions_of(spark))
    for key, value in STREAM_SETTINGS.items():
        session.conf.set(key, value)
    return session


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """A folder every executor can reach: the one given, else that in ``spark.checkpoint.dir``, else
    one under the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return folder or configured or f"{warehouse}/riskloom-work"


def fresh_folder(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A path of its own for one run under the shared folder."""
    return f"{shared_folder(spark, folder).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that a job has written and no longer needs."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
