"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

ROW_GROUP_BYTES = 8 << 20

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app: str = "reviewloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` was given.

    With neither, a session on a local master gets a temporary folder; any other raises an error, as
    its executors would write to disks of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a shared folder; the master is {master}")
    return _own_folder()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="reviewloom-")


def ready_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable on this session."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, readable by every executor."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    Its row groups are small, so a table that came in few splits is read by all cores from here on.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session's settings with ``conf`` among them, put back at the end."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def freed_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of what is run inside go as soon as each action has ended, not when the driver next collects its garbage.

    For actions whose result is written or checkpointed: running the same DataFrame once more would make its shuffles anew.
    """
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
