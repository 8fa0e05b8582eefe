"""What driver and executors share: a folder, and tables cut from their lineage in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors share: the checkpoint folder, or the warehouse where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        checkpoints = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = checkpoints.get() if checkpoints.isDefined() else spark.conf.get("spark.sql.warehouse.dir")
    return named.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(f"{shared_folder(df.sparkSession)}/checkpoints")
    return df.checkpoint()
