"""Sends this package to the executors of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors the package, once per application, so that their tasks can import it from any folder.

    The zip is made on the driver and served to the executors by Spark.
    """
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="lumenframe-"), "lumenframe.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _sent.add(app)
