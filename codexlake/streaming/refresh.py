"""The refresh decision over a stream of change records: every micro-batch is decided like a batch of its own.

An extra beside the batch operator; the budget counts within a micro-batch and partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.refresh import decide


def refresh_stream(spark: SparkSession, source: str, schema, target: str, checkpoint: str, partition: list[str], limit: int):
    """Reads Parquet change files as they come and appends the decisions to target; ends when all that is there is read."""
    changes = spark.readStream.schema(schema).parquet(source)

    def each(batch: DataFrame, number: int) -> None:
        decide(batch, partition, limit).write.mode("overwrite").parquet(f"{target}/batch={number}")  # a repeated batch overwrites itself

    return changes.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
