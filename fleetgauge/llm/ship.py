"""Sending this package to executors that do not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's modules to the Python path of the session's executors, once."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="fleetgauge-code-")) / "fleetgauge.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)
