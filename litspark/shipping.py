"""This package for the executors' Python, wherever they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def send_package(spark: SparkSession) -> None:
    """Pack the package's sources and add them to the session's files, once."""
    sc = spark.sparkContext
    if getattr(sc, "_litspark_sent", False):
        return
    package = Path(__file__).resolve().parent
    packed = Path(tempfile.mkdtemp(prefix="litspark-")) / "litspark_package.zip"
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(packed))
    sc._litspark_sent = True
