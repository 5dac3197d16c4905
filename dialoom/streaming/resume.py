"""Records as a stream: what arrives is appended once, and the latest of each key is kept current."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.incremental import latest


def available_records(spark: SparkSession, path: str, schema, out: str, checkpoint: str, keys: list[str], order: list[str]) -> DataFrame:
    """Take in all JSON-line files that were not taken before, then give the latest record of each key.

    The checkpoint remembers the files, so a run that broke off goes on where it stopped.
    """
    query = spark.readStream.schema(schema).json(path).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return latest(spark.read.parquet(out), keys, order)
