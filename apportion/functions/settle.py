"""A place to stop and keep a frame that later steps use more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """This session's own folder in the one that spark.checkpoint.dir names.

    Where the setting is missing, a local session gets a folder of its own; a cluster, whose nodes share none, an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all nodes share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint"))
    return sc.getCheckpointDir()


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, for files that are written and read again."""
    return f"{shared_folder(spark)}/scratch-{uuid.uuid4()}"


def settle(df: DataFrame) -> DataFrame:
    """df computed once, as a checkpoint in the shared folder; its files outlive lost executors.

    Meant for sums by precinct, county or district, which are far smaller than the ballots they come from.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
