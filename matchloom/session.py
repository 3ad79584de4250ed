"""A session with the settings that the library assumes, and the folder that its tasks share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(name: str = "matchloom", **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution; everything else is left to the cluster. conf: more settings, dots written as double underscores."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.ansi.enabled", "true").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def working_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under spark.checkpoint.dir. Where that is unset, under a local one if the session runs on this machine alone; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="matchloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"
