"""Where Python workers find this package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def find_package(spark: SparkSession) -> None:
    """Put the folder of this package on the path of workers that start from now on.

    It must stand at the same place on every machine; otherwise ship it with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    places = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in places:
        environment["PYTHONPATH"] = ":".join([*places, ROOT])
