"""Session helpers."""

from __future__ import annotations

import os
import shutil
import tempfile
from functools import cache

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", name: str = "millrace", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    n = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


@cache
def _archive() -> str:
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="millrace-ship-"), "millrace")
    return shutil.make_archive(target, "zip", os.path.dirname(here), os.path.basename(here))


_shipped: set[str] = set()  # application ids

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows go to Python in batches of about this size: ten thousand long texts would not fit a worker.
ARROW_BATCH_BYTES = 2 << 20


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the application, once, and bound the batches they
    get in bytes unless the session does."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(ARROW_BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(_archive())
        _shipped.add(context.applicationId)
