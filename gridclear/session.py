"""Session defaults and the scratch folder used by jobs that land files."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app_name: str = "gridclear", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; ``conf`` overrides by full key."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def compiled_in_parts(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside don't fuse operators into methods of more than 8,000 bytes, which the JVM never compiles: those take four times as long."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    usual = spark.conf.get(limit)
    spark.conf.set(limit, "8000")
    try:
        yield
    finally:
        spark.conf.set(limit, usual)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for one job's intermediate files.

    On a cluster this lies in the shared folder named by ``spark.checkpoint.dir``.  A local temporary
    folder is used only by a local master, where driver and executors are one process.
    """
    name = f"{label}-{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{tempfile.mkdtemp(prefix='run-', dir='/tmp')}/{name}"


def ship_package(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once per application, for functions that run in Python workers."""
    package = os.path.dirname(os.path.abspath(__file__))
    shipped = f"{os.path.basename(package)}.zip"
    if any(file.endswith(shipped) for file in spark.sparkContext.listFiles):
        return
    folder = tempfile.mkdtemp(prefix="ship-")
    archive = shutil.make_archive(
        os.path.join(folder, os.path.basename(package)), "zip", os.path.dirname(package), os.path.basename(package)
    )
    spark.sparkContext.addPyFile(archive)


def shipped(function: Callable) -> Callable:
    """``function``, whose first argument is the session, with the package's code sent to the executors before it."""

    @functools.wraps(function)
    def run(spark: SparkSession, *args):
        ship_package(spark)
        return function(spark, *args)

    return run
