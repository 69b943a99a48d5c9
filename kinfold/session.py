"""Prepares a session: the package on executors that do not have it on their path, bounded Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent
#: Rows of an Arrow batch between the JVM and Python workers: whole texts are rows, so a batch of 10000 would be large.
BATCH_ROWS, ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def ship(spark: SparkSession) -> None:
    """Sends the package's sources along with the application, once, unless PYTHONPATH already names its folder.

    It also bounds the session's Arrow batches, which both the executors' JVM and their Python workers hold.
    """
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= ROWS_PER_BATCH:
        spark.conf.set(BATCH_ROWS, str(ROWS_PER_BATCH))
    context = spark.sparkContext
    named = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if str(PACKAGE.parent) in named or getattr(context, "_kinfold_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="kinfold-"), f"{PACKAGE.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(PACKAGE.rglob("*.py")):
            z.write(path, path.relative_to(PACKAGE.parent))
    context.addPyFile(archive)
    context._kinfold_shipped = True
