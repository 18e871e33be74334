"""Sending this package to the executors of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Makes ``receiptflow`` importable in the Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    handle, name = tempfile.mkstemp(prefix="receiptflow-", suffix=".zip")
    with os.fdopen(handle, "wb") as file, zipfile.ZipFile(file, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(name)
    _SHIPPED.add(app)
