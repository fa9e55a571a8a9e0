"""Posteriors against a plain computation; planted good and bad sites; the held-out figure; addresses."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.llm import quality_classifier as Q


def corpus(seed=5, hosts=12):
    rng, rows = random.Random(seed), []
    good_words, bad_words, plain = [f"g{i}" for i in range(60)], [f"b{i}" for i in range(60)], [f"w{i}" for i in range(300)]
    for h in range(hosts):
        for p in range(3):
            rate = (0.95, 0.05, 0.5)[h % 3] if p < 2 else 0.5
            for _ in range(60 if h else 200):
                good = rng.random() < rate
                w = [rng.choice(plain) for _ in range(30)] + [rng.choice(good_words if good != (rng.random() < 0.2) else bad_words) for _ in range(4)]
                rows.append((len(rows), " ".join(w), f"h{h}" if h else None, f"p{p}" if p else None, int(good)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, host string, path string").repartition(4)
    return docs, spark.createDataFrame([(r[0], r[4], 0) for r in rows[::2]], "doc_id long, quality int, toxic int")


def plain_posteriors(rows):
    """host and path strengths and posteriors from (host, path, p) by sums over lists."""
    by_host, by_path = {}, {}
    for h, p, x in rows:
        by_host.setdefault(h, []).append(x)
        by_path.setdefault((h, p), []).append(x)
    every = [x for _, _, x in rows]
    n, mean = len(every), sum(every) / len(every)

    def strength(groups, of):
        inside = sum(sum((x - np.mean(g)) ** 2 for x in g) for g in groups.values()) / (n - len(groups))
        between = sum(len(g) * (np.mean(g) - of(k)) ** 2 for k, g in groups.items())
        if groups is by_host:
            freedom, size = len(groups) - 1, n - sum(len(g) ** 2 for g in groups.values()) / n
        else:
            freedom, size = len(groups) - len(by_host), n - sum(len(g) ** 2 / len(by_host[k[0]]) for k, g in groups.items())
        variance = (between - freedom * inside) / size
        return 1e6 if variance <= 0 else min(max(inside / variance, 0.5), 1e6)

    a, b = strength(by_host, lambda k: mean), strength(by_path, lambda k: np.mean(by_host[k[0]]))
    host = {h: (sum(g) + a * mean) / (len(g) + a) for h, g in by_host.items()}
    return host, {k: (sum(g) + b * host[k[0]]) / (len(g) + b) for k, g in by_path.items()}, b, by_path


def test_posteriors_against_sums(spark):
    docs, labels = frames(spark, corpus())
    got = Q.classify(docs, labels, "host", "path").collect()
    assert len(got) == docs.count()
    host, path, b, groups = plain_posteriors([(r["host"], r["path"], r["document_probability"]) for r in got])
    made = Q.fit(docs, labels, F.col("host"), F.col("path"))
    for r in got:
        key = r["host"], r["path"]
        assert r["host_posterior"] == pytest.approx(host[r["host"]], abs=1e-9) and r["path_posterior"] == pytest.approx(path[key], abs=1e-9)
        p, g = r["document_probability"], groups[key]
        prior = (sum(g) - p + b * host[r["host"]]) / (len(g) - 1 + b)
        logit = math.log(p / (1 - p)) - made.odds + math.log(prior / (1 - prior))
        assert r["posterior"] == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-6)


def test_planted_sites_and_held_out_area(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    made = Q.fit(docs, labels, F.col("host"), F.col("path"))
    assert made.n_held_out > 200 and made.held_out_area > 0.8
    got = {r["doc_id"]: r for r in Q.classify(docs, labels, "host", "path").collect()}
    path = {(r["host"], r["path"]): r["path_posterior"] for r in got.values()}
    assert min(path["h3", "p1"], path["h6", "p1"]) > 0.65 and max(path["h4", "p1"], path["h7", "p1"]) < 0.35 and 0.35 < path["h5", "p1"] < 0.65
    truth = np.array([r[4] for r in rows])
    area = lambda c: Q.area_under_curve(np.array([got[r[0]][c] for r in rows]), truth)
    assert area("posterior") > area("document_probability") + 0.01


def test_sparse_sites_shrink(spark):
    rows = corpus() + [(90_000 + i, "g1 g2 g3 g4 " + "w1 " * 30, f"lone{i}", "p", 1) for i in range(3)]
    got = {r["host"]: r["host_posterior"] for r in Q.classify(*frames(spark, rows), "host", "path").collect()}
    assert all(got["h4"] < got[f"lone{i}"] < got["h3"] + 0.05 for i in range(3))


def test_addresses_and_no_labels(spark):
    urls = spark.createDataFrame([("https://A.example.org/News/x?q=1",), ("http://b.org",), ("nonsense",), (None,)], "url string")
    got = [tuple(r) for r in urls.select(*Q.site(F.col("url"))).collect()]
    assert got[:2] == [("a.example.org", "News"), ("b.org", "")] and got[3] == (None, "")
    docs, labels = frames(spark, corpus()[:300])
    for some in (labels.limit(0), labels.where("quality = 1"), labels.where("doc_id < 0")):
        rows = Q.classify(docs, some, "host", "path").collect()
        assert len(rows) == 300 and all(r["document_probability"] == 0.5 for r in rows)
