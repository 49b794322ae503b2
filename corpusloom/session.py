"""Session settings, and the package on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: What the engine relies on; a cluster adds its own sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}

_shipped: set[str] = set()


def build_session(master: str = "local[*]", partitions: int = 8, **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(master).config(map=SETTINGS | {"spark.sql.shuffle.partitions": str(partitions)} | extra)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers once per application, wherever the driver found it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="corpusloom-")) / "corpusloom.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent).as_posix())
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)
