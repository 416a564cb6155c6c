"""Cutting the lineage of a plan through the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the folder that spark.checkpoint.dir names, else in the warehouse; both are shared."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
