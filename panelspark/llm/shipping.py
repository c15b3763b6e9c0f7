"""Makes this package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship_package(spark: SparkSession) -> None:
    """Hands the package to the executors as Spark does with ``--py-files``.

    Does nothing where workers find it by PYTHONPATH, or when it was handed over before.
    The driver writes one small zip; Spark serves it to every executor.
    """
    sc = spark.sparkContext
    if ROOT in os.environ.get("PYTHONPATH", "").split(os.pathsep) or any("panelspark-code" in f for f in sc.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(), "panelspark-code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(ROOT, "panelspark")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, ROOT))
    sc.addPyFile(path)
