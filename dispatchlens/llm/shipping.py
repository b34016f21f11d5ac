"""Sends this package to the executors, once for an application, for clusters where it isn't installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Python files only; Spark serves the archive from the driver, and it's read nowhere else."""
    application = spark.sparkContext.applicationId
    if application in _sent:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"{root.name}/{file.relative_to(root)}")
    spark.sparkContext.addPyFile(str(archive))
    _sent.add(application)
