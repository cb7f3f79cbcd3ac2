"""Makes the package importable in Python workers, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application (as --py-files would)."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    parent = os.path.dirname(package)
    name = os.path.join(tempfile.mkdtemp(prefix="termtide-code-"), "termtide.zip")
    with zipfile.ZipFile(name, "w") as out:
        for folder, _, files in os.walk(package):
            for file in sorted(files):
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.relpath(path, parent))
    spark.sparkContext.addPyFile(name)
    _SENT.add(app)
