"""Send this package to the executors, which need not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# by application; the archive has to stay while executors may still start
_sent: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Add the package's modules to the Python path of the application's tasks, once."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    folder = _sent[app] = tempfile.TemporaryDirectory(prefix="yearwheel-", ignore_cleanup_errors=True)
    archive = f"{os.path.realpath(folder.name)}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
