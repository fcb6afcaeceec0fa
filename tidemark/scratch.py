"""Intermediate tables, written once and read back, in a folder that all executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import ship_package


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables of this application.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local session
    without that setting falls back to its warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return f"{base.rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The lineage ends here: a lost executor costs a re-read, not a recomputation. The
    folder is removed when the session ends.
    """
    spark = df.sparkSession
    ship_package(spark)
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    folder, system = _on_hadoop(spark, path)
    system.deleteOnExit(folder)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._scratch_path = path
    return kept


def discard(*kept: DataFrame) -> None:
    """Delete tables written by ``keep`` once what was made of them is written itself.

    Only the frame that ``keep`` returned can be discarded; nothing may read it any more.
    """
    for df in kept:
        folder, system = _on_hadoop(df.sparkSession, df._scratch_path)
        system.delete(folder, True)


def _on_hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())
