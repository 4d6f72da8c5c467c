"""Makes this package importable in Python workers of sessions that were started without ``--py-files``, and fits batches to texts."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Bytes of rows that a task exchanges with its Python worker at once. Spark's default is 64 MB, of which it holds several
# copies outside of the heap while whole texts pass; results don't depend on it.
BATCH_BYTES = 2 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors through Spark's own file server, once per application."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parent.parent
        if package.is_dir():  # else it runs from an archive that has been shipped already
            handle, path = tempfile.mkstemp(prefix=f"{package.name}-", suffix=".zip")
            os.close(handle)
            with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
                for file in sorted(package.rglob("*.py")):
                    archive.write(file, file.relative_to(package.parent))
            spark.sparkContext.addPyFile(path)
        _shipped.add(application)
    return spark
