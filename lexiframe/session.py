"""Session defaults shared by the benchmark and the tests."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", app: str = "lexiframe", **extra: str) -> SparkSession:
    """A session with the library's defaults; keyword values override them (``__`` stands for a dot)."""
    conf = DEFAULTS | {k.replace("__", "."): v for k, v in extra.items()}
    spark = SparkSession.builder.master(master).appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def expose_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    That suffices where the path is the same everywhere, as on one machine;
    elsewhere the package has to be shipped to the executors.
    """
    root, environment = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
