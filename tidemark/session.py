"""Session helpers: defaults for local runs and the shared checkpoint folder."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "tidemark", cores: str = "8", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers once per application.

    Functions that run in workers refer to its modules, and a worker has only what the
    session sends it."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tidemark-package-")  # read by the driver alone
    shutil.copytree(package, f"{folder}/in/tidemark", ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/tidemark", "zip", f"{folder}/in"))
    context._tidemark_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared folder there, so that checkpoints outlive the
    executor that wrote them. Only a local session gets a folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    context.setCheckpointDir(folder)
    return folder
