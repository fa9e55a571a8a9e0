"""Quality classifier: document evidence combined with host and path posteriors by hierarchical empirical Bayes.

1. Labelled ids are taken by hash buckets, at most ``max_fit_rows`` (the only bounded sample; a parameter), and dealt into
   three folds. Words of the first fold are counted by hashed bucket among good and bad documents; a word's weight is its
   smoothed log ratio. A logistic regression on the second fold weighs a document's words against the counts of the
   quality rules (rates of symbols, bars, capitals, repeats, ...). The third fold is held out: ``fit`` reports the area
   under its curve. Where the classes of a fold are too few, folds are put together.
2. The document's evidence is its log odds less those of the fitting fold.
3. Hosts and paths: probabilities are summed by host and by (host, path), with their squares. The analysis of variance for
   groups of unequal sizes gives the variance within and between groups, and their ratio is the strength of each level's
   prior, in documents: a host shrinks toward the global mean, a path toward its host, sparse ones the more. All sums are
   over whole tables.
4. A document's prior is its path's posterior mean without the document itself; its posterior log odds are the prior's
   plus its evidence. It is kept from ``keep`` upward.

Sums are pre-aggregated by (host, path), so a host with a third of all rows is a row by task before it is exchanged;
groups are joined back from staged tables. What reaches the driver and executors is bounded: the sample's ids and
features, and ``WORD_BUCKETS`` word weights.

Null texts count as empty; null hosts and paths are groups of their own; a document that labels call good and bad counts
as bad; null labels are ignored. Without labels of both kinds every document has even evidence. Repeated rows count and
are scored as often as they occur. Texts of any length are read whole. An empty table gives an empty result. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import words as W
from siftwell.llm.quality_rules import COUNTS, counts
from siftwell.llm.tables import table, text_or_empty
from siftwell.plans.staging import stage

MAX_FIT_ROWS = 50_000
FIT_BUCKETS = 1 << 14
WORD_BUCKETS = 1 << 18
RIDGE = 1.0
KEEP = 0.3
STRENGTHS = (0.5, 1e6)
FEATURES = ("log_words", "word_length", "symbol_rate", "duplicate_line_rate", "repeat_rate", "upper_rate", "bar_rate", "line_words", "word_evidence")


def site(url: Column) -> tuple[Column, Column]:
    """Host and first path segment of a web address."""
    return F.lower(F.try_parse_url(url, F.lit("HOST"))), F.regexp_extract(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "^/?([^/]*)", 1)


def _buckets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Place of each text and the distinct hashed buckets of its words, A-Z lower-cased."""
    for lo, hi in W.slices(texts):
        words = W.split(texts.slice(lo, hi - lo), lower=True)
        hashed = (words.hashes() % np.uint64(WORD_BUCKETS)).astype(np.int64)
        edges = words.first.tolist()
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            yield lo + i, np.unique(hashed[a:b])


def labelled_ids(docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS, id_col: str = "doc_id") -> DataFrame:
    """doc_id, quality, fold of whole hash buckets of labelled ids, at most ``max_fit_rows``.

    The more there are, the finer the buckets: always the first ``FIT_BUCKETS`` hold about as many rows as fit.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    ids = stage(docs.select(F.col(id_col).cast("long").alias("doc_id")).join(known, "doc_id").groupBy("doc_id").agg(F.first("quality").alias("quality"), F.count("*").alias("rows")), "labelled")
    total = ids.agg(F.sum("rows")).first()[0] or 0
    buckets = FIT_BUCKETS * max(1, math.ceil(total / max_fit_rows))
    bucketed = ids.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets))).where(F.col("bucket") < FIT_BUCKETS)
    left, taken = max_fit_rows, []
    for bucket, n in sorted(map(tuple, bucketed.groupBy("bucket").agg(F.sum("rows")).collect())):
        if n <= left:
            left -= n
            taken.append(bucket)
    kept = bucketed.where(F.col("bucket").isin(taken) if taken else F.lit(False))
    return stage(kept.select("doc_id", "quality", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)).cast("int").alias("fold")), "fit_ids")


def word_weights(texts: DataFrame) -> np.ndarray:
    """A weight for each word bucket from rows of (text, quality): the smoothed log ratio of good and bad documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, held = batch.column(1).to_numpy(zero_copy_only=False) == 1, np.zeros((2, WORD_BUCKETS), dtype=np.int64)
            for i, own in _buckets(W.flat(batch.column(0))):
                held[int(good[i]), own] += 1
            some = np.flatnonzero(held.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[0, some]), pa.array(held[1, some])], names=["bucket", "bad", "good"])

    found = texts.select("text", "quality").mapInArrow(run, "bucket long, bad long, good long").groupBy("bucket").agg(F.sum("bad"), F.sum("good")).collect()
    n = texts.agg(F.count_if(F.col("quality") == 0), F.count_if(F.col("quality") == 1)).first()
    out = np.zeros(WORD_BUCKETS)
    for bucket, bad, good in found:
        out[bucket] = math.log((good + 1) / (n[1] + 2)) - math.log((bad + 1) / (n[0] + 2))
    return out


def features(docs: DataFrame, host: Column, path: Column, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, host, path and the features of each row, staged."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.flat(batch.column(3))
            found = counts(texts)
            evidence = np.zeros(len(texts))
            if sent.value.any():
                for i, own in _buckets(texts):
                    evidence[i] = sent.value[own].sum() / math.sqrt(max(len(own), 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(found[:, k]) for k in range(len(COUNTS))), pa.array(evidence)], names=["doc_id", "host", "path", *COUNTS, "word_evidence"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), text_or_empty(text_col).alias("text"))
    counted = slim.mapInArrow(run, f"doc_id long, host string, path string, {', '.join(f'{c} long' for c in COUNTS)}, word_evidence double")
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    made = {
        "log_words": F.log1p("n_words"),
        "word_length": F.col("word_chars") / words,
        "symbol_rate": F.col("n_symbols") / words,
        "duplicate_line_rate": F.col("n_dup_lines") / lines,
        "repeat_rate": F.col("n_repeat_words") / words,
        "upper_rate": F.col("n_upper") / F.greatest("word_chars", F.lit(1)),
        "bar_rate": F.col("n_bars") / words,
        "line_words": F.log1p(F.col("n_words") / lines),
    }
    return stage(counted.select("doc_id", "host", "path", "word_evidence", *[c.alias(n) for n, c in made.items()]), "features")


def regression(rows: np.ndarray, good: np.ndarray, ridge: float = RIDGE, steps: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres, scales and weights (the last is the intercept) of a ridge logistic regression, by Newton's method."""
    centre, scale = rows.mean(axis=0), rows.std(axis=0)
    scale[scale == 0] = 1.0
    x = np.column_stack(((rows - centre) / scale, np.ones(len(rows))))
    weights, penalty = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (good - p) - penalty * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        weights += np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return centre, scale, weights


def area_under_curve(score: np.ndarray, good: np.ndarray) -> float:
    """The share of pairs of a good and a bad row in which the good one scores higher; ties count half."""
    if not 0 < good.sum() < len(good):
        return float("nan")
    ordered = np.sort(score)
    rank = (np.searchsorted(ordered, score) + np.searchsorted(ordered, score, "right") + 1) / 2
    n = good.sum()
    return float((rank[good == 1].sum() - n * (n + 1) / 2) / (n * (len(good) - n)))


@dataclass
class Fit:
    """A fitted model: the rows' features, the log odds as a column over them, the fold's own odds, and its held-out area."""

    rows: DataFrame
    logit: Column
    odds: float
    held_out_area: float
    n_held_out: int


def _usable(good: pd.Series) -> bool:
    return 0 < good.sum() < len(good)


def fit(docs: DataFrame, labels: DataFrame, host: Column, path: Column, max_fit_rows: int = MAX_FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Fit:
    ids = labelled_ids(docs, labels, max_fit_rows, id_col)
    # At most max_fit_rows ids, so sending them has a bound.
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).join(F.broadcast(ids), "doc_id")
    sizes = {r["fold"]: (r["good"], r["bad"]) for r in ids.groupBy("fold").agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")).collect()}
    apart = all(min(sizes.get(f, (0, 0))) >= 10 for f in range(3))
    first = chosen.where("fold = 0") if apart else chosen
    weights = word_weights(first) if sum(min(x) for x in sizes.values()) else np.zeros(WORD_BUCKETS)
    rows = features(docs, host, path, weights, id_col, text_col)
    sample = rows.join(F.broadcast(ids), "doc_id").select(*FEATURES, "quality", "fold").toPandas().sort_values([*FEATURES, "quality", "fold"], ignore_index=True)
    fitting = sample[sample["fold"] == 1] if apart else sample
    if not _usable(fitting["quality"]):
        return Fit(rows, F.lit(0.0), 0.0, float("nan"), 0)
    good = fitting["quality"].to_numpy(dtype=float)
    centre, scale, beta = regression(fitting[list(FEATURES)].to_numpy(dtype=float), good)
    logit = sum(((F.col(f) - float(c)) / float(s) * float(w) for f, c, s, w in zip(FEATURES, centre, scale, beta, strict=False)), F.lit(float(beta[-1])))
    held = sample[sample["fold"] == 2] if apart else sample.iloc[:0]
    score = (held[list(FEATURES)].to_numpy(dtype=float) - centre) / scale @ beta[:-1]
    return Fit(rows, logit, float(np.log(good.mean() / (1 - good.mean()))), area_under_curve(score, held["quality"].to_numpy(dtype=float)), len(held))


def strength(between_squares: float, within: float, freedom: float, size: float) -> float:
    """How many documents a prior is worth: the variance within groups over that between them.

    ``between_squares``: squared differences of group means, weighted by rows; ``freedom``: groups less one;
    ``size``: rows less the sum of squared group sizes over rows, which is what a unit of variance between groups adds.
    """
    if freedom <= 0 or size <= 0:
        return STRENGTHS[1]
    between = (between_squares - freedom * within) / size
    return STRENGTHS[1] if between <= 0 else float(np.clip(within / between, *STRENGTHS))


def classify(docs: DataFrame, labels: DataFrame, host: Column | str = "source", path: Column | str = "lang", keep: float = KEEP, max_fit_rows: int = MAX_FIT_ROWS, **columns) -> DataFrame:
    """A row for each row: doc_id, host, path, document_probability, host_posterior, path_posterior, posterior, kept."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    made = fit(docs, labels, as_column(host), as_column(path), max_fit_rows, **columns)
    scored = made.rows.withColumn("logit", F.greatest(F.least(made.logit, F.lit(15.0)), F.lit(-15.0))).withColumn("p", 1 / (1 + F.exp(-F.col("logit")))).select("doc_id", "host", "path", "logit", "p")
    paths = stage(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")), "paths")
    hosts = stage(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"), F.sum("q").alias("host_q"), F.count("*").alias("host_paths"), F.sum(F.col("n") * F.col("n")).alias("host_n2")), "hosts")
    t = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s"), F.sum("host_q").alias("q"), F.count("*").alias("hosts"), F.sum("host_paths").alias("paths"), F.sum(F.col("host_n") * F.col("host_n")).alias("n2"), F.sum(F.col("host_n2") / F.col("host_n")).alias("inner"), F.sum(F.col("host_s") * F.col("host_s") / F.col("host_n")).alias("of_hosts")).first()
    of_paths = paths.agg(F.sum(F.col("s") * F.col("s") / F.col("n"))).first()[0] or 0.0
    n = t["n"] or 0
    mean = float(np.clip((t["s"] or 0.0) / n, 1e-6, 1 - 1e-6)) if n else 0.5
    host_strength = path_strength = STRENGTHS[1]
    if n:
        within_hosts = max(0.0, t["q"] - t["of_hosts"]) / max(1, n - t["hosts"])
        host_strength = strength(max(0.0, t["of_hosts"] - t["s"] ** 2 / n), within_hosts, t["hosts"] - 1, n - t["n2"] / n)
        within_paths = max(0.0, t["q"] - of_paths) / max(1, n - t["paths"])
        path_strength = strength(max(0.0, of_paths - t["of_hosts"]), within_paths, t["paths"] - t["hosts"], n - t["inner"])
    host_mean = (F.col("host_s") + host_strength * mean) / (F.col("host_n") + host_strength)
    # Nulls are values of their own, so they are written as text beside a mark before groups are joined.
    key = lambda df: df.withColumn("site", F.to_json(F.struct(F.coalesce("host", F.lit("")).alias("h"), F.col("host").isNull().alias("hn"), F.coalesce("path", F.lit("")).alias("p"), F.col("path").isNull().alias("pn"))))
    both = paths.join(hosts.withColumnRenamed("host", "of_host"), F.col("host").eqNullSafe(F.col("of_host"))).withColumn("host_posterior", host_mean)
    sites = key(both).select("site", "n", "s", "host_posterior", ((F.col("s") + path_strength * F.col("host_posterior")) / (F.col("n") + path_strength)).alias("path_posterior"))
    joined = key(scored).join(stage(sites, "sites"), "site")
    others = (F.col("s") - F.col("p") + path_strength * F.col("host_posterior")) / (F.col("n") - 1 + path_strength)
    prior = F.greatest(F.least(others, F.lit(1 - 1e-6)), F.lit(1e-6))
    posterior = 1 / (1 + F.exp(-(F.log(prior / (1 - prior)) + F.col("logit") - made.odds)))
    return joined.select(
        "doc_id", "host", "path", F.col("p").alias("document_probability"), "host_posterior", "path_posterior", posterior.alias("posterior"), (posterior >= keep).alias("kept")
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no address: a source is taken as the host, a language in it as the path."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
