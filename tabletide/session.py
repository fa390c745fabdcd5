"""What a session needs for this package."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

from .errors import TideError


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, whatever the working directory.

    On a cluster whose machines don't have it there, it goes with --py-files as any other package.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all machines share.  Where it is unset, a local session has one of its own; a cluster has none."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise TideError("set spark.checkpoint.dir to a folder that all machines share")
    return os.path.join(tempfile.gettempdir(), "tabletide-checkpoints")


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` as files in the shared folder, so that no row is computed twice, nor in another order."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
