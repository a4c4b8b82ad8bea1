"""Send this package to the executors, for sessions whose workers do not have it on their path."""

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import roster

_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Add the package to the application's Python files, once."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    top = os.path.dirname(os.path.abspath(roster.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="roster-"), "roster.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("roster", os.path.relpath(full, top)))
    context.addPyFile(path)
    _sent.add(context.applicationId)
