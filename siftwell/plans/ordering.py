"""Global row numbers without a window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwell.plans.staging import stage


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with 1, 2, ... in ``order``: rows are range-partitioned and numbered in each part, after those of earlier parts."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = stage(placed, "ordered").withColumn("_part", F.shiftright("_at", 33)).withColumn("_inside", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return placed.join(offsets, "_part").withColumn(name, F.col("_before") + F.col("_inside") + 1).drop("_at", "_part", "_inside", "_before")
