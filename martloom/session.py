"""Session settings and the shared folder in which long plans are cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that fit the jobs of this package; a cluster's own values win (see ``recommended``).
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Let the invoices of a narrow date window prune the scan of their lines: a filtered side up to this size may be
    # turned into a bloom filter for a scan of 10 GB and more.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.session.timeZone": "UTC",
}


def recommended(builder: SparkSession.Builder, **overrides: str) -> SparkSession.Builder:
    """Apply the settings above (and ``overrides``) to a session builder."""
    for key, value in {**SQL_SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder


# Temporary folders of local sessions, by application.
_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``; a temporary folder only where that is unset (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="martloom-")
    return _LOCAL_DIRS[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing has to be cleared."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files when they end, not when the driver next happens to collect garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as stored in the shared folder, so a lost executor does not recompute or change them.

    Columns compress to a fraction of what a checkpoint's serialised rows take, and their size is known to the optimizer.
    """
    path = scratch_path(df.sparkSession, "cut")
    with releasing(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
