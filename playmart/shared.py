"""Tables that cut a lineage: written to the folder that all executors and the driver share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir, set as the checkpoint folder.

    Where it is unset, a folder of this machine is made if all of Spark runs in one process; on a cluster
    the others could not see it, so that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors and the driver share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder and read from there, which cuts the lineage.

    Spark removes them with the frame if spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
