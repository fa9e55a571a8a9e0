"""Nearest neighbours: exact tile by tile, or by an inverted file of k-means lists; and duplicate groups.

Vectors are packed into tiles, binary matrices of a bounded number of rows, so that all scores are matrix products in
tasks. Nothing but the centres of the lists (``sqrt(n)`` of them unless told otherwise) reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions.scalars import unit
from siftwell.operators.graph import connected_components
from siftwell.plans.ordering import numbered
from siftwell.plans.staging import stage

#: Rows of a tile, at most; 64 dimensions in double precision are 2 MB.
TILE_ROWS = 4096
#: Up to so many items ``auto`` is exact: 25 tiles, 625 products of tiles.
EXACT_ITEMS = 100_000
SAMPLE_ROWS, TRAIN_EACH = 256, 256
NEIGHBORS = "image_id string, neighbor_id string, score double, rank int"
_FOUND = "image_id string, neighbor_id string, neighbor_index long, score double"
_TILE = "ids binary, places binary, matrix binary"


def normalized(items: DataFrame, enabled: bool = True) -> DataFrame:
    vector = unit(F.col("embedding")) if enabled else F.transform("embedding", lambda x: x.cast("double"))
    return items.select("row_index", "image_id", vector.alias("embedding"))


def top_k(
    items: DataFrame, k: int, method: str = "auto", tile_rows: int = TILE_ROWS, lists: int | None = None, probes: int = 8, seed: int = 42, recall: float = 0.95, exact_items: int = EXACT_ITEMS, around: np.ndarray | None = None
) -> DataFrame:
    """(image_id, neighbor_id, score, rank): the k items with the largest inner product, the item itself included.

    ``exact`` multiplies every tile with every other: quadratic work, as exactness needs, with a running best k for each
    tile's rows. ``ivf`` compares only items of the nearest of ``lists`` lists (by default the square root of their
    number): ``probes``, or as many more as a hashed sample of items needs to find the share ``recall`` of its exact
    neighbours; ``around`` are centres that were fitted before. ``auto`` is exact up to ``exact_items`` items, else ivf.
    """
    if method not in ("auto", "exact", "ivf"):
        raise ValueError("method is auto, exact or ivf")
    if chosen(items, method, exact_items) == "ivf":
        around = centres(items, lists or list_count(items.count()), seed) if around is None else around
        return _merge(_ivf(items, k, around, probes, recall, tile_rows), k)
    return _exact(items, k, tile_rows)


def chosen(items: DataFrame, method: str, exact_items: int = EXACT_ITEMS) -> str:
    """The method that ``auto`` stands for."""
    return method if method != "auto" else "exact" if items.count() <= exact_items else "ivf"


def list_count(n: int) -> int:
    return max(1, math.isqrt(n))


def _packed(rows: pa.Table) -> tuple[bytes, bytes, bytes]:
    """Ids, row indexes and vectors of some rows, in the order of their row indexes."""
    rows = rows.sort_by("row_index")
    matrix = np.stack(rows.column("embedding").to_numpy()).astype(np.float64) if rows.num_rows else np.zeros((0, 0))
    return "\0".join(rows.column("image_id").to_pylist()).encode(), rows.column("row_index").to_numpy().astype(np.int64).tobytes(), matrix.tobytes()


def _unpacked(ids: bytes, places: bytes, matrix: bytes) -> tuple[list[str], np.ndarray, np.ndarray]:
    names = ids.decode().split("\0")
    return names, np.frombuffer(places, dtype=np.int64), np.frombuffer(matrix, dtype=np.float64).reshape(len(names), -1)


def _best(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best of each row, by score and then by place; ties beyond the k-th are not lost."""
    if scores.shape[1] > 4 * k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        some = np.flatnonzero((scores >= least[:, None]).any(axis=0))
        if len(some) < scores.shape[1] // 2:
            return some[_best(scores[:, some], places[some], k)]
        width = int((scores >= least[:, None]).sum(axis=1).max())
        near = np.argpartition(-scores, min(width, scores.shape[1]) - 1, axis=1)[:, :width]
        order = np.lexsort((places[near], -np.take_along_axis(scores, near, 1)))[:, :k]
        return np.take_along_axis(near, order, 1)
    return np.lexsort((np.broadcast_to(places, scores.shape), -scores))[:, :k]


def _exact(items: DataFrame, k: int, tile_rows: int) -> DataFrame:
    """Each tile meets all tiles in one task, itself first, so only the running best k of its rows are held."""

    def pack(rows: pa.Table) -> pa.Table:
        tile = rows.column("tile")[0].as_py()
        return pa.table([pa.array([x], t) for x, t in zip((tile, *_packed(rows)), (pa.int64(), *[pa.binary()] * 3), strict=True)], names=["tile", "ids", "places", "matrix"])

    cut = items.select("row_index", "image_id", "embedding", F.floor(F.col("row_index") / tile_rows).alias("tile"))
    tiles = stage(cut.groupBy("tile").applyInArrow(pack, f"tile long, {_TILE}"), "tiles")
    every = tiles.agg(F.sort_array(F.collect_list("tile")).alias("every")).first()["every"]
    if not every:
        return items.sparkSession.createDataFrame([], NEIGHBORS)
    met = tiles.withColumn("query", F.explode(F.lit(every)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = None, None
        for batch in batches:
            for tile, query, *parts in zip(*(batch.column(i) for i in range(5)), strict=True):
                names, places, matrix = _unpacked(*(x.as_py() for x in parts))
                if tile.as_py() == query.as_py():
                    if held:
                        yield _answers(own[0], *held)
                    own, held = (names, matrix), None
                scores = own[1] @ matrix.T
                best = _best(scores, places, k)
                found = np.array(names, dtype=object)[best], places[best], np.take_along_axis(scores, best, 1)
                if held:
                    found = tuple(np.concatenate(x, axis=1) for x in zip(held, found, strict=True))
                    order = np.lexsort((found[1], -found[2]))[:, :k]
                    found = tuple(np.take_along_axis(x, order, 1) for x in found)
                held = found
        if held:
            yield _answers(own[0], *held)

    placed = met.select("tile", "query", "ids", "places", "matrix").repartition(F.col("query")).sortWithinPartitions("query", F.col("tile") != F.col("query"), "tile")
    return placed.mapInArrow(search, NEIGHBORS)


def _answers(ids: list[str], names: np.ndarray, places: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    width = names.shape[1]
    columns = [np.repeat(np.array(ids, dtype=object), width), names.ravel(), scores.ravel(), np.tile(np.arange(1, width + 1, dtype=np.int32), len(ids))]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2]), pa.array(columns[3])], names=["image_id", "neighbor_id", "score", "rank"])


def _merge(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("image_id").orderBy(F.desc("score"), "neighbor_index")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("image_id", "neighbor_id", "score", "rank")


def centres(items: DataFrame, lists: int, seed: int = 42) -> np.ndarray:
    """Centres of the lists, fitted on ``TRAIN_EACH`` items a list, taken by a hash of their ids."""
    sample = items.orderBy(F.xxhash64("image_id"), "row_index").limit(lists * TRAIN_EACH)
    return np.array(KMeans(k=lists, seed=seed, maxIter=10).fit(sample.select(array_to_vector("embedding").alias("features"))).clusterCenters())


def _ivf(items: DataFrame, k: int, around: np.ndarray, probes: int, recall: float, tile_rows: int) -> DataFrame:
    """Scores of each item against the lists it probes; lists and their queries are cut into tiles, so none is one task's."""
    n = min(max(probes, _probes_for(items, around, k, recall)), len(around))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = np.stack(batch.column("embedding").to_numpy(zero_copy_only=False))
                order = np.argsort((around**2).sum(1) - 2 * vectors @ around.T, axis=1, kind="stable")[:, :n]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(order.tolist(), pa.list_(pa.int32()))], names=[*batch.schema.names, "lists"])

    listed = stage(items.mapInArrow(nearest, "row_index long, image_id string, embedding array<double>, lists array<int>"), "lists")
    asked = listed.select(F.explode("lists").alias("list_id"), F.lit(1).alias("asked"), F.lit(0).alias("held")).unionByName(listed.select(F.col("lists")[0].alias("list_id"), F.lit(0).alias("asked"), F.lit(1).alias("held")))
    sizes = stage(asked.groupBy("list_id").agg(F.ceil(F.sum("asked") / tile_rows).alias("query_tiles"), F.ceil(F.sum("held") / tile_rows).alias("tiles")).where("tiles > 0"), "list_sizes")
    part = lambda name, seed: F.pmod(F.xxhash64("image_id", F.lit(seed)), F.col(name)).alias(name[:-1])
    base = listed.withColumn("list_id", F.col("lists")[0]).join(F.broadcast(sizes), "list_id")
    base = base.select("list_id", part("tiles", 1), F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_tiles") - 1)).alias("query_tile"), "row_index", "image_id", "embedding")
    asking = listed.withColumn("list_id", F.explode("lists")).join(F.broadcast(sizes), "list_id")
    asking = asking.select("list_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile"), part("query_tiles", 2), F.col("image_id").alias("query_id"), F.col("embedding").alias("query"))

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return pa.table([pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=["image_id", "neighbor_id", "neighbor_index", "score"])
        names, places = np.array(rows.column("image_id").to_pylist(), dtype=object), rows.column("row_index").to_numpy()
        scores = np.stack(queries.column("query").to_numpy()) @ np.stack(rows.column("embedding").to_numpy()).T
        best = _best(scores, places, k)
        ids = np.repeat(np.array(queries.column("query_id").to_pylist(), dtype=object), best.shape[1])
        return pa.table([pa.array(ids, pa.string()), pa.array(names[best].ravel(), pa.string()), pa.array(places[best].ravel()), pa.array(np.take_along_axis(scores, best, 1).ravel())], names=["image_id", "neighbor_id", "neighbor_index", "score"])

    on = ("list_id", "tile", "query_tile")
    return asking.groupBy(*on).cogroup(base.groupBy(*on)).applyInArrow(search, _FOUND)


def _probes_for(items: DataFrame, around: np.ndarray, k: int, recall: float) -> int:
    """The fewest lists in which a hashed sample of items finds the share ``recall`` of its exact k neighbours."""
    sample = items.orderBy(F.xxhash64("image_id", F.lit(1)), "row_index").limit(SAMPLE_ROWS).select("image_id", "embedding").collect()
    if not sample:
        return 1
    own = np.array([r["embedding"] for r in sample])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors, places = np.stack(batch.column("embedding").to_numpy(zero_copy_only=False)), batch.column("row_index").to_numpy()
                scores = own @ vectors.T
                best = _best(scores, places, k)
                at = ((around**2).sum(1) - 2 * vectors @ around.T).argmin(1)
                columns = [np.repeat(np.arange(len(own)), best.shape[1]), places[best].ravel(), np.take_along_axis(scores, best, 1).ravel(), at[best].ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "place", "score", "list_id"])

    order = Window.partitionBy("query").orderBy(F.desc("score"), "place")
    found = items.select("row_index", "embedding").mapInArrow(scan, "query long, place long, score double, list_id long")
    rows = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "list_id").collect()
    turn = np.argsort(np.argsort((around**2).sum(1) - 2 * own @ around.T, axis=1, kind="stable"), axis=1)
    needed = np.sort([turn[r["query"], r["list_id"]] for r in rows]) + 1
    return int(needed[int(np.ceil(recall * len(needed))) - 1])


def rerank(candidates: DataFrame, k: int) -> DataFrame:
    """Neighbours without the item itself, the first k by score."""
    order = Window.partitionBy("image_id").orderBy(F.desc("score"), "rank")
    others = candidates.where("image_id <> neighbor_id").withColumn("new_rank", F.row_number().over(order))
    return others.where(F.col("new_rank") <= k).select("image_id", "neighbor_id", "score", F.col("new_rank").alias("rank"))


def duplicate_edges(neighbors: DataFrame, threshold: float) -> DataFrame:
    """Unordered pairs at or above the threshold with their largest score, and how many directed edges made each."""
    near = neighbors.where(F.col("score") >= threshold)
    return near.groupBy(F.least("image_id", "neighbor_id").alias("left_id"), F.greatest("image_id", "neighbor_id").alias("right_id")).agg(
        F.max("score").alias("score"), F.count("*").alias("directed")
    )


def duplicate_members(items: DataFrame, edges: DataFrame) -> DataFrame:
    """duplicate_group_id, image_id, component of each member of a group; numbered among all components, single items included, by first member."""
    labels = connected_components(edges, "left_id", "right_id").withColumnRenamed("node", "image_id")
    members = items.select("image_id", "row_index").join(labels, "image_id", "left").withColumn("component", F.coalesce("component", "image_id"))
    sizes = members.groupBy("component").agg(F.min("row_index").alias("first_index"), F.count("*").alias("size"))
    named = numbered(sizes, ["first_index"], "number").where("size > 1").select("component", F.format_string("dup_%05d", "number").alias("duplicate_group_id"))
    return members.join(named, "component").select("duplicate_group_id", "image_id", "component")


def duplicate_groups(members: DataFrame, edges: DataFrame) -> DataFrame:
    """duplicate_group_id, image_ids, size, max_similarity of the groups of ``duplicate_members``.

    A row holds all of a group's ids, as an export wants it; whatever goes on works on the members' rows.
    """
    groups = members.groupBy("duplicate_group_id", "component").agg(F.count("*").cast("int").alias("size"), F.sort_array(F.collect_list("image_id")).alias("image_ids"))
    best = edges.join(members.select(F.col("image_id").alias("left_id"), "component"), "left_id").groupBy("component").agg(F.greatest(F.max("score"), F.lit(0.0)).alias("max_similarity"))
    return groups.join(best, "component").select("duplicate_group_id", "image_ids", "size", "max_similarity")
