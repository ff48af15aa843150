"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from .errors import ChangeError

#: Runtime settings the operators rely on. ANSI casts make a bad value fail the batch, UTC makes
#: zone-less text mean UTC, TimeType is still behind a switch in Spark 4.1, and AQE sizes shuffles.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session; all of them can be set while it runs."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def set_for(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the jobs that run inside, and what it was before afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def scratch_root(spark: SparkSession) -> str:
    """The folder for staged data, shared by all executors.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset (tests on one machine)
    is a temporary folder made, and the session remembers it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ChangeError("Set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="changeloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below :func:`scratch_root` that nobody else uses."""
    return f"{scratch_root(spark)}/changeloom/{label}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle starts with, before AQE joins small ones."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, which do not share the driver's import path."""
    context = spark.sparkContext
    if getattr(context, "_changeloom_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="changeloom-"), "changeloom")
    archive = shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    context._changeloom_shipped = True
