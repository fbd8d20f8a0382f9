"""Tables between stages in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.
    Only where that is unset and all runs in one process (tests) is it one of
    our own; on a cluster it must be set."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        current = context._jsc.sc().getCheckpointDir()
        if current.isDefined():
            folder = current.get()
        elif context._jsc.sc().isLocal():
            folder = os.path.join(tempfile.gettempdir(), "checkpoints", "quillmark")
            context.setCheckpointDir(folder)
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return folder.rstrip("/")


def checkpointed(rows: DataFrame) -> DataFrame:
    """Rows written to the shared folder: an operator that reads its input
    several times would compute it as often, and stages composed without a cut
    would multiply.  A lost executor costs a re-read."""
    context = rows.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()
