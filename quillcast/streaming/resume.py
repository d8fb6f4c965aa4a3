"""Incremental processing of folders: each run takes what is new, then stops.

The checkpoint remembers which files were read, which is what resume files and done markers do in batch tools.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_new(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, change: Callable[[DataFrame], DataFrame] = lambda df: df, fmt: str = "parquet") -> None:
    """Append ``change`` of all new files of ``source`` to the Parquet table ``target`` and return when done."""
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    query = change(stream).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    query.awaitTermination()


def run_new_batches(spark: SparkSession, source: str, schema: str, checkpoint: str, each: Callable[[DataFrame, int], None], fmt: str = "parquet") -> None:
    """The same for changes that need whole batches (windows, grouped maps): ``each`` gets a batch and its number."""
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
