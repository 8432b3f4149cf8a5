"""Makes this package importable in the executors' Python."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Adds the package to the application's Python files, once. Spark hands them to executors."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    path = Path(tempfile.mkdtemp()) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(_PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(_PACKAGE.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)
