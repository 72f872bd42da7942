"""The package's code for the Python workers of a session that was started without it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Spark send the package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    path = Path(tempfile.mkdtemp(prefix="starmart-code-")) / "starmart.zip"
    with zipfile.ZipFile(path, "w") as made:
        for source in sorted(PACKAGE.rglob("*.py")):
            made.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)
