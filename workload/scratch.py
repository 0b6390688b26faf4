"""Test-only: a scratch folder for sessions of one machine that name none."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def ensure_scratch(spark: SparkSession) -> None:
    """Name a temporary folder where a local session has none; a cluster has to name a shared one.

    Without it the library raises when a job has something to store.
    """
    master = spark.sparkContext.master
    one_machine = master == "local" or master.startswith("local[")
    if one_machine and not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="scratch-"))
