"""Session settings for this package, and shipping it to the executors."""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffle partitions from the data and splits skewed join
# partitions; the shared folder for checkpoints has to be named by the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_shipped: set[str] = set()
_lock = threading.Lock()


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings this package is written for."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Called where a function of the package runs inside tasks, so it need not be
    installed on the executors.
    """
    context = spark.sparkContext
    with _lock:  # fits are submitted from several threads
        if context.applicationId in _shipped:
            return
        package = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(
            tempfile.mkdtemp(prefix="cohortloom-package-"), f"cohortloom-{uuid.uuid4().hex}"
        )
        archive = shutil.make_archive(
            target, "zip", os.path.dirname(package), os.path.basename(package)
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
