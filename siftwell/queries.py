"""The engine's queries by name over the supplied tables, and the SQL that checks them.

The tables hold no images: vectors stand in for embedding output, documents and pages for assets, events for the log of
review decisions. Stand-in columns are deterministic expressions over keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.config import Section, section
from siftwell.functions import imaging
from siftwell.functions.scalars import sampled, stable_id
from siftwell.operators import cluster, decide, export, ingest, prelabel, quality, review, vectors
from siftwell.plans.staging import shared_dir, stage
from siftwell.sources import readers

LABELS, HIGH_RISK, RUN, DATASET, NEAR, TOP_K, FINAL_K = ("product", "defect", "unknown"), ("defect",), "run", "demo", 0.4, 20, 10
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None, *ctes: str):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = _with(sql, *ctes)
        return f

    return register


#: Common table expressions of the oracles, each with those it needs.
_CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "docs_in": ((), "SELECT doc_id AS row_index, 'doc://' || md5(text) AS uri, substr(sha1('demo:doc://' || md5(text)), 1, 16) AS image_id FROM documents"),
    "ranked": (("docs_in",), "SELECT *, row_number() OVER (PARTITION BY uri ORDER BY row_index) AS k FROM docs_in"),
    "assets": (
        (),
        """SELECT doc_id AS row_index, n_chars AS file_size, CAST(doc_id % 97 * 5 AS INT) AS width, CAST(doc_id % 89 * 5 AS INT) AS height,
        CASE WHEN doc_id % 31 = 0 THEN 'GIF' ELSE 'PNG' END AS format, doc_id % 41 * 1.0 AS blur_score, doc_id % 23 * 1.0 AS channel_stddev,
        doc_id % 53 = 0 AS missing, doc_id % 59 = 0 AS broken FROM documents""",
    ),
    "hits": (
        ("assets",),
        """SELECT *, CASE WHEN missing THEN ['missing_local_file'] WHEN broken THEN ['decode_failed'] ELSE list_filter([
        CASE WHEN file_size < 256 THEN 'file_too_small' END, CASE WHEN file_size > 20000 THEN 'file_too_large' END,
        CASE WHEN format NOT IN ('JPEG','PNG','WEBP','BMP','TIFF') THEN 'unsupported_format' END, CASE WHEN width < 64 OR height < 64 THEN 'image_too_small' END,
        CASE WHEN width * height < 4096 THEN 'too_few_pixels' END,
        CASE WHEN greatest(width::DOUBLE / greatest(height, 1), height::DOUBLE / greatest(width, 1)) > 6 THEN 'aspect_ratio_extreme' END,
        CASE WHEN blur_score < 18 THEN 'blurry' END, CASE WHEN channel_stddev < 4 THEN 'low_information' END], lambda x: x IS NOT NULL) END AS r FROM assets""",
    ),
    "judged": (
        ("hits",),
        """SELECT *, CASE WHEN list_has_any(r, ['missing_local_file','decode_failed','unsupported_format','image_too_small','too_few_pixels']) THEN 'drop'
        WHEN list_has_any(r, ['file_too_large','low_information']) THEN 'quarantine' WHEN len(r) > 0 THEN 'needs_review' ELSE 'keep' END AS quality_status FROM hits""",
    ),
    "v": ((), "SELECT vec_id AS row_index, 'img' || vec_id AS image_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings"),
    "u": (("v",), "SELECT row_index, image_id, label, list_transform(e, lambda x: x / greatest(sqrt(list_dot_product(e, e)), 1e-12)) AS e FROM v"),
    "pairs": (("u",), "SELECT a.image_id, b.image_id AS neighbor_id, b.row_index AS j, list_dot_product(a.e, b.e) AS score FROM u a, u b"),
    "cand": (("pairs",), "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, j) AS rank FROM pairs) WHERE rank <= 20"),
    "topk": (
        ("cand",),
        "SELECT * FROM (SELECT image_id, neighbor_id, score, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, rank) AS rank FROM cand WHERE image_id <> neighbor_id) WHERE rank <= 10",
    ),
    "edges": (("topk",), "SELECT least(image_id, neighbor_id) AS l, greatest(image_id, neighbor_id) AS r, max(score) AS score, count(*) AS directed FROM topk WHERE score >= 0.4 GROUP BY 1, 2"),
    "reach": (("edges", "u"), "SELECT image_id AS a, image_id AS b FROM u UNION SELECT reach.a, CASE WHEN l = reach.b THEN r ELSE l END FROM reach JOIN edges ON l = reach.b OR r = reach.b"),
    "comp": (("reach", "u"), "SELECT a AS image_id, min(u.row_index) AS c FROM reach JOIN u ON u.image_id = reach.b GROUP BY a"),
    "comps": (("comp",), "SELECT c, count(*) AS size, list(image_id ORDER BY image_id) AS ids, row_number() OVER (ORDER BY c) AS n FROM comp GROUP BY c"),
    "groups": (
        ("comps", "comp", "edges"),
        "SELECT printf('dup_%05d', n) AS g, ids, size, s.score FROM comps JOIN (SELECT c, max(score) AS score FROM edges JOIN comp ON comp.image_id = edges.l GROUP BY c) s USING (c) WHERE size > 1",
    ),
    "cen": (("u",), "SELECT label, list(x ORDER BY i) AS m FROM (SELECT label, i, avg(e[i]) AS x FROM u, range(1, 65) t(i) GROUP BY ALL) GROUP BY label"),
    "dist": (("u", "cen"), "SELECT row_index, image_id, label, sqrt(list_sum(list_transform(e, lambda x, i: (x - m[i]) * (x - m[i])))) AS d FROM u JOIN cen USING (label)"),
    "clus": (
        ("dist",),
        """SELECT row_index, image_id, printf('cluster_%05d', label) AS cluster_id, d, d >= (SELECT quantile_cont(d, 0.99) FROM dist) AS is_outlier,
        row_number() OVER (PARTITION BY label ORDER BY d, row_index) <= 5 AS is_representative FROM dist""",
    ),
    "pre": (
        ("v",),
        """SELECT image_id, row_index, list(struct_pack(label := l, confidence := round(CASE WHEN k > 1 THEN greatest(0.01, 0.45 - 0.08 * k) WHEN weak IS NOT NULL THEN 0.96
        ELSE 0.55 + ('0x' || substr(sha1(image_id), 9, 8))::BIGINT % 40 / 100.0 END::DOUBLE, 4)) ORDER BY k) AS c FROM (
        SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY (CASE WHEN l = weak THEN 0 ELSE 1 END), sha1(image_id || '|' || l)) AS k FROM (
        SELECT image_id, row_index, CASE WHEN ('0x' || substr(sha1(image_id), 1, 8))::BIGINT / 4294967295.0 < 0.85 THEN ['product','defect','unknown'][label % 3 + 1] END AS weak,
        unnest(['product','defect','unknown']) AS l FROM v)) GROUP BY ALL""",
    ),
    "stats": (
        ("clus", "pre"),
        """SELECT cluster_id, l AS main_label, n / s::DOUBLE AS main_ratio, s AS labelled FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, f) AS k,
        sum(n) OVER (PARTITION BY cluster_id) AS s FROM (SELECT cluster_id, c[1].label AS l, count(*) AS n, min(clus.row_index) AS f FROM clus JOIN pre USING (image_id) GROUP BY ALL)) WHERE k = 1""",
    ),
    "memb": (("groups",), "SELECT g, unnest(ids) AS image_id FROM groups"),
    "conf": (("memb", "pre"), "SELECT DISTINCT image_id FROM memb WHERE g IN (SELECT g FROM memb JOIN pre USING (image_id) GROUP BY g HAVING count(DISTINCT c[1].label) > 1)"),
    "qual": (("v",), "SELECT row_index, image_id, CASE row_index % 25 WHEN 0 THEN 'drop' WHEN 1 THEN 'quarantine' WHEN 2 THEN 'needs_review' ELSE 'keep' END AS q FROM v"),
    "dec": (
        ("qual", "pre", "clus", "stats", "conf"),
        """SELECT qual.*, c, is_outlier, is_representative, list_filter([CASE WHEN q <> 'keep' THEN 'quality_' || q END, CASE WHEN c IS NULL THEN 'missing_prelabel' END,
        CASE WHEN c[1].confidence < 0.9 THEN 'low_confidence' END, CASE WHEN c[1].confidence - c[2].confidence < 0.75 THEN 'low_margin' END, CASE WHEN c[1].label = 'defect' THEN 'high_risk_label' END,
        CASE WHEN c IS NOT NULL AND conf.image_id IS NOT NULL THEN 'duplicate_label_conflict' END,
        CASE WHEN c[1].label <> main_label OR main_ratio < 0.6 THEN 'cluster_label_inconsistent' END], lambda x: x IS NOT NULL) AS r
        FROM qual LEFT JOIN (SELECT * EXCLUDE row_index FROM pre WHERE row_index % 37 <> 5) p USING (image_id) LEFT JOIN clus USING (image_id) LEFT JOIN stats USING (cluster_id) LEFT JOIN conf USING (image_id)""",
    ),
    "ann": (
        ("dec",),
        """SELECT *, CASE WHEN len(r) = 0 THEN 'auto_accepted' WHEN q = 'drop' THEN 'invalid' ELSE 'pending' END AS st, c[1].label AS rec,
        CASE WHEN len(r) = 0 THEN c[1].label END AS fin FROM dec""",
    ),
    "que": (
        ("ann", "memb"),
        """SELECT *, list_filter([CASE WHEN st = 'pending' THEN 'pending' END, CASE WHEN q <> 'keep' THEN 'quality_risk' END, CASE WHEN c[1].confidence < 0.9 THEN 'low_confidence' END,
        CASE WHEN is_outlier THEN 'outlier' END, CASE WHEN is_representative THEN 'cluster_representative' END, CASE WHEN image_id IN (SELECT image_id FROM memb) THEN 'duplicate_candidate' END,
        CASE WHEN st = 'auto_accepted' AND ('0x' || substr(sha1(image_id), 1, 8))::BIGINT / 4294967295.0 < 0.2 THEN 'auto_accept_sample' END], lambda x: x IS NOT NULL) AS rr FROM ann""",
    ),
    "queue": (
        ("que",),
        """SELECT substr(sha1('run:' || image_id), 1, 16) AS review_task_id, image_id, rec, q, st, rr, list_min(list_transform(rr, lambda x: CASE x WHEN 'pending' THEN 10 WHEN 'low_confidence' THEN 20
        WHEN 'quality_risk' THEN 30 WHEN 'duplicate_candidate' THEN 40 WHEN 'outlier' THEN 50 WHEN 'cluster_representative' THEN 60 ELSE 70 END)) AS priority FROM que WHERE len(rr) > 0""",
    ),
    "log": (
        (),
        """SELECT event_id AS seq, 'img' || user_id AS image_id, CASE event_type WHEN 'view' THEN 'accept' WHEN 'click' THEN 'correct' WHEN 'purchase' THEN 'reject' WHEN 'error' THEN 'invalid' ELSE 'later' END AS a,
        CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN '' ELSE 'product' END AS l, props AS note FROM events""",
    ),
    "fold": (("log",), "SELECT image_id, arg_max(struct_pack(a := a, l := l), seq) FILTER (a <> 'later') AS x, arg_max(coalesce(note, ''), seq) AS note FROM log GROUP BY image_id"),
    "fin": (
        ("ann", "fold"),
        """SELECT ann.image_id, CASE WHEN x.a = 'accept' THEN coalesce(nullif(x.l, ''), rec) WHEN x.a = 'correct' THEN x.l WHEN x.a IS NOT NULL THEN NULL ELSE fin END AS fl,
        CASE x.a WHEN 'accept' THEN 'human_accepted' WHEN 'correct' THEN 'corrected' WHEN 'reject' THEN 'rejected' WHEN 'invalid' THEN 'invalid' ELSE st END AS fs,
        CASE WHEN x.a IS NOT NULL THEN 'human_review' WHEN st = 'auto_accepted' THEN 'auto_decision' ELSE 'pending_review' END AS src, note FROM ann LEFT JOIN fold USING (image_id)""",
    ),
}


def _with(final: str, *names: str) -> str:
    order: list[str] = []

    def need(name: str) -> None:
        for x in _CTE[name][0]:
            need(x)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    body = ",\n".join(f"{n} AS ({_CTE[n][1]})" for n in order)
    return f"WITH RECURSIVE {body}\n{final}" if order else final


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _document_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, "documents").select(F.col("doc_id").alias("row_index"), F.concat(F.lit("doc://"), F.md5("text")).alias("uri"))
    return ingest.manifest_rows(rows, DATASET)[0]


def _assets(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    return _read(spark, d, "documents").select(
        i.alias("row_index"), F.concat(F.lit("doc"), i).alias("image_id"), F.when(i % 53 != 0, F.lit("/x")).alias("local_path"), F.col("n_chars").alias("file_size"), (i % 97 * 5).cast("int").alias("width"), (i % 89 * 5).cast("int").alias("height"), F.when(i % 31 == 0, "GIF").otherwise("PNG").alias("format"), (i % 41).cast("double").alias("blur_score"), (i % 23).cast("double").alias("channel_stddev"), F.when(i % 59 == 0, F.lit("undecodable")).alias("decode_error")
    )


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return quality.apply_rules(_assets(spark, d), section("quality", max_file_size_bytes=20000))


def _items(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, "embeddings").select(F.col("vec_id").alias("row_index"), F.concat(F.lit("img"), "vec_id").alias("image_id"), "embedding")
    return vectors.normalized(rows)


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return vectors.top_k(_items(spark, d), TOP_K)


def _neighbors(spark: SparkSession, d: str) -> DataFrame:
    return vectors.rerank(_candidates(spark, d), FINAL_K)


def _near(spark: SparkSession, d: str) -> DataFrame:
    return stage(vectors.duplicate_edges(_neighbors(spark, d), NEAR), "near")


def _groups(spark: SparkSession, d: str) -> DataFrame:
    """Members of groups."""
    return stage(vectors.duplicate_members(_items(spark, d), _near(spark, d)), "members")


def _assigned(spark: SparkSession, d: str) -> DataFrame:
    labels = _read(spark, d, "embeddings").select(F.col("vec_id").alias("row_index"), F.col("label").alias("cluster"))
    return _items(spark, d).join(labels, "row_index")


def _distances(spark: SparkSession, d: str) -> DataFrame:
    rows = _assigned(spark, d)
    return cluster.with_distance(rows.join(cluster.centroids(rows), "cluster"))


def _clusters(spark: SparkSession, d: str) -> DataFrame:
    return stage(cluster.cluster_rows(cluster.representatives(cluster.outliers(_distances(spark, d)))), "clusters")


def _prelabels(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, "embeddings").select(F.col("vec_id").alias("row_index"), F.concat(F.lit("img"), "vec_id").alias("image_id"), "label")
    weak = F.when(sampled(F.col("image_id"), 0.85), F.element_at(F.array(*map(F.lit, LABELS)), (F.col("label") % 3 + 1).cast("int")))
    return prelabel.mock(rows, LABELS, 3, weak)


def _annotations(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    i = F.col("vec_id")
    status = F.when(i % 25 == 0, "drop").when(i % 25 == 1, "quarantine").when(i % 25 == 2, "needs_review").otherwise("keep")
    rows = _read(spark, d, "embeddings").select(i.alias("row_index"), F.concat(F.lit("img"), i).alias("image_id"), F.concat(F.lit("vec://"), i).alias("uri"), status.alias("quality_status"), F.array().cast("array<string>").alias("quality_reasons"))
    groups, labels = _groups(spark, d), _prelabels(spark, d)
    some = labels.join(rows.where(F.col("row_index") % 37 != 5), "image_id", "left_semi")
    config = section("auto_decision", min_margin=0.75, min_cluster_main_label_ratio=0.6)
    clusters = _clusters(spark, d)
    decided = _decide(rows, labels, some, clusters, groups, config)
    return stage(decide.annotations(decided, RUN), "annotations"), groups


def _decide(rows: DataFrame, labels: DataFrame, some: DataFrame, clusters: DataFrame, groups: DataFrame, config: Section) -> DataFrame:
    """As in the oracle, statistics see all prelabels and decisions some of them."""
    blank = labels.join(some.select("image_id"), "image_id", "left_anti").select("image_id")
    decided = decide.decide(rows, labels, clusters, groups, config, HIGH_RISK)
    none = decide.decide(rows.join(blank, "image_id", "left_semi"), labels.limit(0), clusters, groups, config, HIGH_RISK)
    return decided.join(blank, "image_id", "left_anti").unionByName(none)


def _final(spark: SparkSession, d: str) -> DataFrame:
    action = F.create_map(*[F.lit(x) for x in ("view", "accept", "click", "correct", "purchase", "reject", "error", "invalid")])
    label = F.when(F.col("event_id") % 3 == 1, "").when(F.col("event_id") % 3 == 2, "product")
    log = _read(spark, d, "events").select(
        F.col("event_id").alias("seq"), F.concat(F.lit("img"), "user_id").alias("image_id"), F.coalesce(F.try_element_at(action, F.col("event_type")), F.lit("later")).alias("action_type"), label.alias("final_label"), F.coalesce("props", F.lit("")).alias("note"), F.col("ts").cast("string").alias("created_at")
    )
    return review.apply_decisions(_annotations(spark, d)[0], log)


@_query("SELECT url AS uri, substr(sha1('demo:' || url), 1, 16) AS image_id, octet_length(encode(html)) AS file_size, sha256(html) AS content_hash FROM pages")
def manifest_build(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return _read(spark, d, "pages").select(F.col("url").alias("uri"), stable_id(DATASET, F.col("url"), none).alias("image_id"), F.octet_length("html").cast("long").alias("file_size"), F.sha2("html", 256).alias("content_hash"))


_PLACE = "row_number() OVER (ORDER BY {0}) - 1 AS row_index"


def _written(rows: DataFrame, key: str, label: str) -> str:
    """A folder of text files in the shared folder that have the rows' lines in order of their key."""
    path = f"{shared_dir(rows.sparkSession)}/siftwell/{label}-{uuid.uuid4().hex}"
    rows.repartitionByRange(key).sortWithinPartitions(key).select("line").write.text(path)
    return path


@_query(f"SELECT {_PLACE.format('page_id')}, url AS uri, substr(sha1('demo:' || url), 1, 16) AS image_id, page_id % 7 AS part FROM pages")
def manifest_source(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, "pages").select("page_id", F.to_json(F.struct(F.col("url").alias("uri"), F.struct((F.col("page_id") % 7).alias("part")).alias("metadata"))).alias("line"))
    found = ingest.manifest_rows(readers.manifest(spark, _written(rows, "page_id", "manifest")), DATASET)[0]
    return found.select("row_index", "uri", "image_id", F.get_json_object("metadata", "$.part").cast("long").alias("part"))


@_query(f"SELECT {_PLACE.format('doc_id')}, 'file:///data/a%20b/' || doc_id || '.png' AS uri, '/data/a b/' || doc_id || '.png' AS local_path, row_number() OVER (ORDER BY doc_id) AS line FROM documents")
def path_list_source(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.when(F.col("doc_id") % 2 == 0, "/data/a b/").otherwise("file:///data/a%20b/"), "doc_id", F.lit(".png"))
    found = readers.path_list(spark, _written(_read(spark, d, "documents").select("doc_id", path.alias("line")), "doc_id", "paths"))
    return found.select("row_index", "uri", "local_path", F.get_json_object("metadata", "$.path_list_line").cast("long").alias("line"))


@_query("SELECT vec_id AS row_index, 64 AS width, 48 AS height, 'PNG' AS format, abs(vec_id % 200 - label * 20 % 256) / 2.0 AS channel_stddev FROM embeddings")
def image_features(spark: SparkSession, d: str) -> DataFrame:
    """Of generated images: the left half has one level of grey, the right half another."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                pixels = np.full((48, 64, 3), a, dtype=np.uint8)
                pixels[:, 32:] = b
                made.append(imaging.encode_png(pixels))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["row_index", "content"])

    rows = _read(spark, d, "embeddings").select(F.col("vec_id").alias("row_index"), F.col("vec_id") % 200, F.col("label") * 20 % 256)
    made = rows.mapInArrow(draw, "row_index long, content binary").withColumn("f", imaging.features("content"))
    return made.select("row_index", "f.width", "f.height", "f.format", F.round("f.channel_stddev", 6).alias("channel_stddev"))


@_query("SELECT row_index, image_id, uri FROM ranked WHERE k = 1", "ranked")
def ingest_dedup(spark: SparkSession, d: str) -> DataFrame:
    return ingest.first_by_uri(_document_rows(spark, d))[0].select("row_index", "image_id", "uri")


@_query(
    """WITH RECURSIVE t AS (SELECT doc_id AS row_index, 'd' || (doc_id * 7 % 97) AS image_id, 'u' || ((doc_id // 3) * 5 % 61) AS uri, row_number() OVER (ORDER BY doc_id) AS n FROM documents),
    walk AS (SELECT 0::BIGINT AS n, []::VARCHAR[] AS ids, []::VARCHAR[] AS uris, []::BIGINT[] AS kept UNION ALL
    SELECT t.n, CASE WHEN new THEN list_append(ids, t.image_id) ELSE ids END, CASE WHEN new THEN list_append(uris, t.uri) ELSE uris END, CASE WHEN new THEN list_append(kept, t.row_index) ELSE kept END
    FROM walk JOIN (SELECT *, n - 1 AS before FROM t) t ON t.before = walk.n, LATERAL (SELECT NOT list_contains(ids, t.image_id) AND NOT list_contains(uris, t.uri) AS new))
    SELECT row_index, image_id, uri FROM t WHERE row_index IN (SELECT unnest(kept) FROM walk WHERE n = (SELECT max(n) FROM t))"""
)
def ingest_first_wins(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    rows = _read(spark, d, "documents").select(i.alias("row_index"), F.concat(F.lit("d"), i * 7 % 97).alias("image_id"), F.concat(F.lit("u"), F.floor(i / 3) * 5 % 61).alias("uri"))
    return ingest.first_wins(rows)[0].select("row_index", "image_id", "uri")


@_query("SELECT row_index, image_id, uri, 'duplicate_input' AS error_code FROM ranked WHERE k > 1", "ranked")
def ingest_errors(spark: SparkSession, d: str) -> DataFrame:
    return ingest.duplicate_errors(ingest.first_by_uri(_document_rows(spark, d))[1]).select("row_index", "image_id", "uri", "error_code")


@_query("SELECT count(*) AS input_count, count(*) FILTER (k = 1) AS output_count, count(*) FILTER (k > 1) AS duplicate_count, 0::BIGINT AS invalid_uri_count FROM ranked", "ranked")
def ingest_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = _document_rows(spark, d)
    accepted, rejected = ingest.first_by_uri(rows)
    return ingest.ingest_summary(rows, accepted, rejected, rows.where("uri IS NULL"))


@_query("SELECT row_index, quality_status, array_to_string(r, ',') AS reasons FROM judged", "judged")
def quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).select("row_index", "quality_status", F.array_join("quality_reasons", ",").alias("reasons"))


@_query("SELECT quality_status, count(*) AS n FROM judged GROUP BY 1", "judged")
def quality_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.status_counts(_judged(spark, d))


@_query("SELECT reason, count(*) AS n FROM (SELECT unnest(r) AS reason FROM judged) GROUP BY 1", "judged")
def quality_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.reason_counts(_judged(spark, d))


@_query("SELECT row_index FROM judged WHERE quality_status IN ('keep', 'needs_review') AND NOT missing", "judged")
def embedding_candidates(spark: SparkSession, d: str) -> DataFrame:
    return quality.embedding_candidates(_judged(spark, d)).select("row_index")


_S = "('0x' || substr(sha1(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967295.0"


@_query(f"SELECT doc_id, {_S} < 0.02 AS in_2, {_S} < 0.5 AS in_50, false AS in_0, true AS in_100 FROM documents")
def stable_sample(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    return _read(spark, d, "documents").select("doc_id", sampled(i, 0.02).alias("in_2"), sampled(i, 0.5).alias("in_50"), sampled(i, 0.0).alias("in_0"), sampled(i, 1.0).alias("in_100"))


@_query("SELECT image_id, neighbor_id, round(score, 6) AS score, rank FROM cand", "cand")
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("image_id", "neighbor_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@_query("SELECT image_id, neighbor_id, round(score, 6) AS score, rank FROM topk", "topk")
def rerank_topk(spark: SparkSession, d: str) -> DataFrame:
    return _neighbors(spark, d).select("image_id", "neighbor_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@_query("SELECT l AS left_id, r AS right_id, round(score, 6) AS score, directed FROM edges", "edges")
def duplicate_edges(spark: SparkSession, d: str) -> DataFrame:
    return vectors.duplicate_edges(_neighbors(spark, d), NEAR).withColumn("score", F.round("score", 6))


@_query("SELECT g AS duplicate_group_id, array_to_string(ids, ',') AS image_ids, size::INT AS size, round(score, 6) AS max_similarity FROM groups", "groups")
def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    near = _near(spark, d)
    groups = vectors.duplicate_groups(stage(vectors.duplicate_members(_items(spark, d), near), "members"), near)
    return groups.withColumn("image_ids", F.array_join("image_ids", ",")).withColumn("max_similarity", F.round("max_similarity", 6))


@_query("SELECT label AS cluster, i - 1 AS i, round(m[i], 6) AS x FROM cen, range(1, 65) t(i)", "cen")
def centroids(spark: SparkSession, d: str) -> DataFrame:
    return cluster.centroids(_assigned(spark, d)).select("cluster", F.posexplode("centroid").alias("i", "x")).select("cluster", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


@_query("SELECT image_id, round(d, 6) AS distance FROM dist", "dist")
def centroid_distance(spark: SparkSession, d: str) -> DataFrame:
    return _distances(spark, d).select("image_id", F.round("distance_to_centroid", 6).alias("distance"))


@_query("SELECT image_id FROM clus WHERE is_outlier", "clus")
def outliers(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d).where("is_outlier").select("image_id")


@_query("SELECT cluster_id, image_id FROM clus WHERE is_representative", "clus")
def representatives(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d).where("is_representative").select("cluster_id", "image_id")


@_query("SELECT cluster_id, count(*) AS size, count(*) FILTER (is_outlier) AS outlier_count FROM clus GROUP BY 1", "clus")
def cluster_summary(spark: SparkSession, d: str) -> DataFrame:
    return cluster.cluster_sizes(_clusters(spark, d))


@_query("SELECT image_id, k AS rank, c[k].label AS label, c[k].confidence AS confidence FROM pre, range(1, 4) t(k)", "pre")
def prelabel_mock(spark: SparkSession, d: str) -> DataFrame:
    return _prelabels(spark, d).select("image_id", F.explode("candidates").alias("c")).select("image_id", F.col("c.rank").cast("long").alias("rank"), "c.label", "c.confidence")


@_query("SELECT c[1].label AS label, count(*) AS n FROM pre GROUP BY 1", "pre")
def prelabel_label_counts(spark: SparkSession, d: str) -> DataFrame:
    return prelabel.label_counts(_prelabels(spark, d))


_B = "CASE WHEN x >= 0.95 THEN '0.95-1.00' WHEN x >= 0.9 THEN '0.90-0.95' WHEN x >= 0.8 THEN '0.80-0.90' WHEN x >= 0.6 THEN '0.60-0.80' ELSE '0.00-0.60' END"


@_query(f"SELECT {_B} AS bucket, count(*) AS n FROM (SELECT c[1].confidence AS x FROM pre) GROUP BY 1", "pre")
def confidence_buckets(spark: SparkSession, d: str) -> DataFrame:
    return prelabel.bucket_counts(_prelabels(spark, d))


@_query("SELECT cluster_id, main_label, round(main_ratio, 6) AS main_ratio, labelled::BIGINT AS labelled FROM stats", "stats")
def cluster_label_stats(spark: SparkSession, d: str) -> DataFrame:
    return decide.cluster_label_stats(_clusters(spark, d), _prelabels(spark, d)).withColumn("main_ratio", F.round("main_ratio", 6))


@_query("SELECT image_id FROM conf", "conf")
def duplicate_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return decide.duplicate_conflicts(_groups(spark, d), _prelabels(spark, d))


@_query("SELECT image_id, st AS decision_status, rec AS recommended_label, fin AS final_label, array_to_string(r, ',') AS reasons FROM ann", "ann")
def auto_decision(spark: SparkSession, d: str) -> DataFrame:
    return _annotations(spark, d)[0].select("image_id", F.col("final_status").alias("decision_status"), "recommended_label", "final_label", F.array_join("reasons", ",").alias("reasons"))


@_query("SELECT reason, count(*) AS n FROM (SELECT unnest(CASE WHEN len(r) = 0 THEN ['auto_accepted'] ELSE r END) AS reason FROM ann) GROUP BY 1", "ann")
def decision_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.reason_counts(_annotations(spark, d)[0], "reasons", "auto_accepted")


def _queue(spark: SparkSession, d: str) -> DataFrame:
    rows, groups = _annotations(spark, d)
    return review.review_queue(rows, groups, RUN, section("review", sampling={"auto_accept_qa_ratio": 0.2}))


_TASK = "review_task_id, image_id, rec AS recommended_label, q AS quality_status, st AS final_status, priority::INT AS priority, array_to_string(rr, ',') AS reasons"


def _task(queue: DataFrame) -> DataFrame:
    return queue.select("review_task_id", "image_id", "recommended_label", "quality_status", "final_status", "priority", F.array_join("reasons", ",").alias("reasons"))


@_query(f"SELECT {_TASK} FROM queue", "queue")
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    return _task(_queue(spark, d))


@_query("SELECT reason, count(*) AS n FROM (SELECT unnest(rr) AS reason FROM queue) GROUP BY 1", "queue")
def review_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.reason_counts(_queue(spark, d), "reasons")


@_query(f"SELECT {_TASK} FROM queue ORDER BY priority, image_id LIMIT 50 OFFSET 20", "queue")
def review_page(spark: SparkSession, d: str) -> DataFrame:
    return _task(review.page(_queue(spark, d), 20, 50))


@_query("SELECT image_id, fl AS final_label, fs AS final_status, src AS source, note AS review_note FROM fin", "fin")
def review_fold(spark: SparkSession, d: str) -> DataFrame:
    return _final(spark, d).select("image_id", "final_label", "final_status", "source", "review_note")


@_query("SELECT image_id, fl AS final_label, fs AS final_status FROM fin WHERE fs IN ('auto_accepted', 'human_accepted', 'corrected') AND coalesce(fl, '') <> ''", "fin")
def export_valid(spark: SparkSession, d: str) -> DataFrame:
    return export.valid(_final(spark, d)).select("image_id", "final_label", "final_status")


@_query(
    """, ok AS (SELECT *, fs IN ('auto_accepted', 'human_accepted', 'corrected') AND coalesce(fl, '') <> '' AS g FROM fin)
    SELECT 'status' AS kind, fs AS name, count(*) AS n FROM fin GROUP BY ALL UNION ALL SELECT 'label', fl, count(*) FROM ok WHERE g GROUP BY ALL UNION ALL
    SELECT 'total', 'all', count(*) FROM ok UNION ALL SELECT 'total', 'valid', count(*) FROM ok WHERE g UNION ALL SELECT 'total', 'pending', count(*) FROM ok WHERE fs = 'pending'""",
    "fin",
)
def export_summary(spark: SparkSession, d: str) -> DataFrame:
    return export.export_counts(_final(spark, d))


@_query("SELECT ann.image_id, st AS final_status, neighbor_id, round(score, 6) AS score FROM ann LEFT JOIN topk USING (image_id) WHERE ann.image_id = 'img7'", "ann", "topk")
def image_detail(spark: SparkSession, d: str) -> DataFrame:
    rows = _annotations(spark, d)[0].where("image_id = 'img7'")
    return rows.join(_neighbors(spark, d), "image_id", "left").select("image_id", "final_status", "neighbor_id", F.round("score", 6).alias("score"))


@_query()
def kmeans_clusters(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d)
    rows = cluster.with_distance(cluster.kmeans(items, cluster.cluster_count(items.count(), 10), 20))
    return cluster.cluster_rows(cluster.representatives(cluster.outliers(rows)))


@_query()
def ivf_topk(spark: SparkSession, d: str) -> DataFrame:
    return vectors.top_k(_items(spark, d), FINAL_K, "ivf", lists=16, probes=8)


