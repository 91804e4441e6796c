"""Session settings the operators are written for, and shipping of this package."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Small Arrow batches: a row may be a whole book, and a batch sits in a Python worker.
# Concurrent writers: a stage split over a few folders is then not sorted by folder first.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.sql.session.timeZone": "UTC",
}
_shipped_to: set[str] = set()


def build_session(app: str = "transqa", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, for clients and scorers they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped_to:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="run-"), "transqa"),
        "zip", os.path.dirname(package), os.path.basename(package),
    )
    spark.sparkContext.addPyFile(archive)
    _shipped_to.add(app)
