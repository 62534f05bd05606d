"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app_name: str = "termloom", **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Only planning settings are set here; master, memory and executor counts belong to the
    cluster (or to ``conf``).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


_scratch: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, for tables between two jobs.

    A scratch folder is made only for a ``local`` master; on a cluster a missing setting is an
    error, because a folder on one machine does not survive the loss of that machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if not _scratch:
        _scratch.append(tempfile.mkdtemp(prefix="termloom-checkpoint-"))
    return _scratch[0]
