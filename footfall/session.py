"""Spark session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def get_session(app_name: str = "footfall", master: str | None = None, **conf: object) -> SparkSession:
    """Build a session. On a cluster, sizing comes from spark-submit and only the
    semantics-bearing settings are fixed here."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path every executor can reach, under the folder in ``spark.checkpoint.dir``.

    Only a local-mode session, where driver and executors are one process, may fall
    back to a machine-local temporary folder, which goes when the process ends. Folders on
    shared storage stay until the caller, who chose the place, removes them.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return f"{shared.rstrip('/')}/footfall-{uuid.uuid4().hex}/{label}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="footfall-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"{folder}/{label}"
