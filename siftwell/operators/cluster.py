"""Clusters: assignment, distances, outliers, representatives, summaries."""

from __future__ import annotations

import math

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions.scalars import distance
from siftwell.plans.ordering import numbered


def cluster_count(n: int, configured: int | str) -> int:
    wanted = min(10_000, max(100, math.ceil(math.sqrt(n)))) if configured == "auto" else int(configured)
    return max(1, min(n, wanted))


def kmeans(items: DataFrame, k: int, max_iter: int = 100, seed: int = 42, fit_rows: int | None = None) -> DataFrame:
    """items with cluster (int) and centroid; one cluster has the mean of all.

    With ``fit_rows`` the centres are fitted on about so many items, taken by a hash of their ids, as mini-batches would see;
    every item is assigned. Centres are sent to executors: k vectors, of which ``cluster_count`` allows 10,000 by itself.
    """
    if k <= 1:
        return items.withColumn("cluster", F.lit(0)).join(F.broadcast(centroids(items.withColumn("cluster", F.lit(0)))), "cluster")
    ready = items.withColumn("features", array_to_vector("embedding"))
    n = ready.count() if fit_rows else 0
    some = ready.where(F.pmod(F.xxhash64("image_id", F.lit(5)), F.lit(1 << 30)) < int((1 << 30) * fit_rows / n)) if fit_rows and n > fit_rows else ready
    model = KMeans(k=k, seed=seed, maxIter=max_iter).fit(some.repartitionByRange("row_index").sortWithinPartitions("row_index"))
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    centers = items.sparkSession.createDataFrame(rows, "cluster int, centroid array<double>")
    return model.transform(ready).withColumnRenamed("prediction", "cluster").drop("features").join(F.broadcast(centers), "cluster")


def centroids(assigned: DataFrame) -> DataFrame:
    """cluster, centroid: the mean vector."""
    each = assigned.select("cluster", F.posexplode("embedding").alias("i", "x")).groupBy("cluster", "i").agg(F.avg("x").alias("x"))
    return each.groupBy("cluster").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda v: v["x"]).alias("centroid"))


def with_distance(assigned: DataFrame) -> DataFrame:
    return assigned.withColumn("distance_to_centroid", distance(F.col("embedding"), F.col("centroid")))


def percentile_of(rows: DataFrame, column: str, share: float) -> float | None:
    """The exact percentile of a column, linearly interpolated, by places in the order of all rows; nulls are passed over."""
    held = rows.select(F.col(column).alias("x")).where("x IS NOT NULL")
    n = held.count()
    if not n:
        return None
    at = share * (n - 1)
    lo = math.floor(at)
    found = {r["place"]: r["x"] for r in numbered(held, ["x"], "place").where(F.col("place").isin(lo + 1, min(lo + 2, n))).collect()}
    low, high = found[lo + 1], found[min(lo + 2, n)]
    return low + (high - low) * (at - lo)


def outliers(rows: DataFrame, percentile: float = 99.0, enabled: bool = True) -> DataFrame:
    """Adds is_outlier: at or above the global percentile of distances, linearly interpolated."""
    if not enabled:
        return rows.withColumn("is_outlier", F.lit(False))
    limit = percentile_of(rows, "distance_to_centroid", percentile / 100)
    return rows.withColumn("is_outlier", F.col("distance_to_centroid") >= F.lit(float("inf") if limit is None else limit))


def representatives(rows: DataFrame, n: int = 5) -> DataFrame:
    order = Window.partitionBy("cluster").orderBy("distance_to_centroid", "row_index")
    return rows.withColumn("is_representative", F.row_number().over(order) <= n)


def cluster_rows(rows: DataFrame) -> DataFrame:
    return rows.select("row_index", "image_id", F.format_string("cluster_%05d", "cluster").alias("cluster_id"), "distance_to_centroid", "is_outlier", "is_representative")


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster_id").agg(F.count("*").alias("size"), F.count_if("is_outlier").alias("outlier_count"))


def summary(clusters: DataFrame, algorithm: str, requested: int) -> DataFrame:
    sizes = cluster_sizes(clusters)
    named = clusters.where("is_representative").groupBy("cluster_id").agg(F.sort_array(F.collect_list("image_id")).alias("ids"))
    both = sizes.join(named, "cluster_id", "left")
    return both.agg(
        F.lit(algorithm).alias("algorithm"),
        F.lit(requested).alias("requested_cluster_count"),
        F.count("*").cast("int").alias("effective_cluster_count"),
        F.sum("size").alias("image_count"),
        F.map_from_entries(F.collect_list(F.struct("cluster_id", "size"))).alias("cluster_sizes"),
        F.sum("outlier_count").alias("outlier_count"),
        F.map_from_entries(F.collect_list(F.struct("cluster_id", F.coalesce("ids", F.array().cast("array<string>"))))).alias("representatives"),
    )


