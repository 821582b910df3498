"""Sessions, and the package's way to Python workers."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings that suit the operators; what a cluster sets itself goes before them.
DEFAULTS = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}


def session(name: str = "gridquill") -> SparkSession:
    return SparkSession.builder.appName(name).config(map=DEFAULTS).getOrCreate()


def workers_see_package(spark: SparkSession) -> SparkSession:
    """Python workers on this host find the package wherever the driver was started.

    On a cluster the package is installed or passed with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark
