"""The package where Python workers run."""

from __future__ import annotations

import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]


@cache
def _shipped(application: str, context) -> str:
    path = Path(tempfile.mkdtemp(prefix=f"{PACKAGE.name}-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(PACKAGE.rglob("*.py")):
            archive.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(path))
    return str(path)


def ship(spark: SparkSession) -> None:
    """Sends the package's source to all executors, once per application, so that functions defined in it can run there."""
    _shipped(spark.sparkContext.applicationId, spark.sparkContext)
