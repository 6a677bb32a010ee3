"""Session defaults and scratch space."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app_name: str = "sluiceway", **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; everything else is left to the cluster.

    Dates are derived from timestamps, so the zone is fixed. Shuffles start wide and adaptive
    execution merges them, which is why no partition count is set here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only where ``spark.checkpoint.dir`` is unset (tests, a laptop) a local folder is made, and it
    is remembered in the session so that later calls agree.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("sluiceway.local.dir", None)
    if not base and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="sluiceway-")
        spark.conf.set("sluiceway.local.dir", base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), "sluiceway", f"{label}-{uuid.uuid4().hex}")


def ship_package(spark: SparkSession) -> None:
    """Python workers load functions of the package by name, so they get a copy, once a session."""
    context = spark.sparkContext
    if spark.conf.get("sluiceway.shipped", None) == context.applicationId:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="sluiceway-")
    context.addPyFile(shutil.make_archive(os.path.join(folder, "sluiceway"), "zip", root, "sluiceway"))
    spark.conf.set("sluiceway.shipped", context.applicationId)
