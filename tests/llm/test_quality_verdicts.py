"""Cutoffs and verdicts against a plain computation; the bound holds on rows that chose nothing."""

import math
import random

from siftwell.llm import quality_rules as Q


def rows(n, seed):
    rng, out = random.Random(seed), []
    for i in range(n):
        good = rng.random() < 0.8
        w = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(25, 60))]
        if not good:
            w = [x + "|#" * rng.randrange(0, 4) for x in w]
        elif rng.random() < 0.01:
            w = [x + "|" for x in w]
        out.append((i, " ".join(w), (None, "", "en")[i % 3] if seed == 1 else "en", int(good)))
    return out


def tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_verdicts_against_plain_cutoffs(spark):
    data = rows(4500, 1)
    data += data[:300]
    docs = spark.createDataFrame([r[:3] for r in data], "doc_id long, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[3], 0) for r in data[:4500]], "doc_id long, quality int, toxic int")
    risk, delta = 0.05, 0.05
    got = Q.judge(docs, labels, risk, delta).collect()
    assert len(got) == len(data)
    own = {(r["doc_id"]): r for r in got}
    value = lambda r, m: {"symbol_rate": r["n_symbols"], "duplicate_line_rate": r["n_dup_lines"], "repeat_rate": r["n_repeat_words"], "upper_rate": r["n_upper"], "bar_rate": r["n_bars"]}[m] / max(1, {"duplicate_line_rate": r["n_lines"], "upper_rate": r["word_chars"]}.get(m, r["n_words"]))
    limits = {}
    for lang in (None, "", "en"):
        good = [own[i] for i, _, s, q in data[:4500] if q and s == lang and not own[i]["base_failed"]]
        for m in Q.MEASURES:
            for rung in reversed(Q.ladder(m)):
                if tail(sum(value(r, m) >= rung for r in good), len(good), risk / len(Q.MEASURES)) > delta / (3 * len(Q.MEASURES)):
                    break
                limits[lang, m] = rung
    assert any(v for v in limits.values())
    for i, _, lang, _ in data:
        bad = [m for m in Q.MEASURES if (lang, m) in limits and value(own[i], m) >= limits[lang, m]]
        assert own[i]["rejected_by"] == ",".join(bad) and own[i]["kept"] == (not own[i]["base_failed"] and not bad)
    assert sum(not own[r[0]]["kept"] for r in data[:4500] if not r[3]) > 300


def test_repeated_texts_are_one_trial(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(i, text, "en") for i in range(3000)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(3000)], "doc_id long, quality int, toxic int")
    found = Q.thresholds(Q.measure(docs), labels).first()
    assert all(found[f"max_{m}"] is None for m in Q.MEASURES)


def test_few_good_documents_are_lost(spark):
    learned, other = rows(4000, 2), rows(4000, 3)
    docs = spark.createDataFrame([r[:3] for r in learned] + [(10_000 + r[0], *r[1:3]) for r in other], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3], 0) for r in learned], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in Q.judge(docs, labels, 0.05).collect()}
    good = [got[10_000 + r[0]] for r in other if r[3]]
    assert sum(bool(r["rejected_by"]) for r in good) / len(good) <= 0.06
