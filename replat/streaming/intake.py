"""Incremental intake: each run reads only the files that arrived since the last one.

The contract is a daily cadence, not real time, so the stream runs with ``availableNow`` and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_REPLY = "key string, content string, input_tokens bigint, output_tokens bigint"


def land_new_replies(spark: SparkSession, replies: str, table: str, checkpoint: str) -> None:
    """Append model replies (JSON lines) that arrived since the last call, with the time of their file."""
    rows = spark.readStream.schema(_REPLY).json(replies)
    _drain(rows.withColumn("arrived", F.col("_metadata.file_modification_time")), table, checkpoint)


def _drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
