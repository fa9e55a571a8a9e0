"""Manifest ingest as a stream: each new file is read once, and what was read is in the stream's checkpoint."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftwell.functions.scalars import stable_id
from siftwell.sources.readers import MANIFEST


def ingest_available(spark: SparkSession, source: str, target: str, checkpoint: str, dataset_id: str) -> StreamingQuery:
    """Append the rows with a uri of all files not read yet to ``target``, then stop."""
    rows = spark.readStream.schema(MANIFEST).json(source).where(F.coalesce(F.trim("uri"), F.lit("")) != "")
    made = rows.withColumn("image_id", stable_id(dataset_id, F.col("uri"), F.col("image_id")))
    return made.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
