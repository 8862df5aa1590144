"""The folder all executors share, and frames written there once per application."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_lock = threading.RLock()
_folders: dict[str, str] = {}
_written: dict[tuple[str, str], str] = {}
_locks: dict[tuple[str, str], threading.RLock] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for local sessions without it."""
    context = spark.sparkContext
    named = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor reaches")
    with _lock:
        if context.applicationId not in _folders:
            _folders[context.applicationId] = tempfile.mkdtemp(prefix="furrow-")
        return _folders[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to."""
    leaf = f"{re.sub(r'[^A-Za-z0-9.]+', '-', name)}-{uuid.uuid4().hex[:12]}"
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{leaf}"


def written_path(spark: SparkSession, name: str, write: Callable[[str], None]) -> str:
    """Run ``write(path)`` on the first call for ``name`` in this application."""
    key = (spark.sparkContext.applicationId, name)
    with _lock:
        own = _locks.setdefault(key, threading.RLock())
    with own:  # unrelated writes do not wait for one another
        if key not in _written:
            path = fresh_path(spark, name)
            write(path)
            _written[key] = path
        return _written[key]


def written_once(
    spark: SparkSession, name: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write a frame at its first use and read it back; this also cuts the lineage.

    Partitioned output is rebalanced, so that a large partition value is spread over several
    files and a small one does not scatter into one file per task.
    """

    def write(path: str) -> None:
        frame = build()
        if partition_by:
            frame = frame.hint("rebalance", *partition_by)
        frame.write.partitionBy(*partition_by).parquet(path)

    return spark.read.parquet(written_path(spark, name, write))
