"""Verdicts and links of the near-duplicate stage that sketches or leaders alone would get wrong."""

import numpy as np
import pyarrow as pa

from siftwell.llm import resemblance, simhash


def shingle_set(text, size=5):
    w = text.lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def likeness(a, b):
    return len(a & b) / len(a | b)


def groups(texts):
    sets = [shingle_set(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = 0
    for i in range(len(texts)):
        for j in range(i):
            if likeness(sets[i], sets[j]) >= 0.8:
                pairs += 1
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return [root(i) for i in range(len(texts))], pairs


def long_pairs(n=60, words=1500):
    rng = np.random.default_rng(5)
    texts = []
    for k in range(n):
        w = [f"v{x}" for x in rng.integers(0, 50000, words)]
        at = rng.choice(words // 6, size=29 + k % 6, replace=False) * 6
        other = list(w)
        for i in at:
            other[i] = f"e{k}x{i}"
        texts += [" ".join(w), " ".join(other)]
    return texts


def components(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(rows, **options).collect()}
    return [found[i] for i in range(len(texts))]


def test_long_pairs_near_the_threshold(spark):
    texts = long_pairs()
    real = [likeness(shingle_set(a), shingle_set(b)) >= 0.8 for a, b in zip(texts[::2], texts[1::2], strict=True)]
    assert 0 < sum(real) < len(real)
    got = components(spark, texts)
    assert [got[2 * i] == got[2 * i + 1] for i in range(len(real))] == real


def chains_and_loose_groups():
    """Revision chains whose ends are unlike, and a template with independent edits whose pairs are about 0.8."""
    rng, texts = np.random.default_rng(9), []
    for c in range(3):
        w = [f"c{c}w{i}" for i in range(200)]
        for step in range(12):
            texts.append(" ".join(w))
            for at in rng.choice(200, 3, replace=False):
                w[at] = f"c{c}s{step}x{at}"
    base = [f"t{i}" for i in range(300)]
    for j in range(80):
        w = list(base)
        for at in rng.choice(300, 6 + j % 4, replace=False):
            w[at] = f"l{j}x{at}"
        texts.append(" ".join(w))
    return texts


def test_chain_of_windows(spark):
    # Neighbours alone are alike: the ends of the chain must meet through all between them.
    line = [f"w{i}" for i in range(200)]
    texts = [" ".join(line[9 * k : 9 * k + 104]) for k in (0, 3, 1, 2, 7)]
    assert components(spark, texts) == [0, 0, 0, 0, 4] == groups(texts)[0]


def test_recall_on_chains_and_loose_groups(spark):
    texts = chains_and_loose_groups()
    expected, pairs = groups(texts)
    got = components(spark, texts)
    sets = [shingle_set(t) for t in texts]
    kept = sum(got[i] == got[j] for i in range(len(texts)) for j in range(i) if likeness(sets[i], sets[j]) >= 0.8)
    print(f"recall {kept} of {pairs}")
    assert kept == pairs and got == expected


def boilerplate(n, seed=3):
    """Texts of which shared passages are 60 to 95 %, of several lengths, and near copies of some."""
    rng, texts = np.random.default_rng(seed), []
    passages = [[f"p{k}x{i}" for i in range(120)] for k in range(3)]
    for j in range(n):
        own = [f"o{j}x{i}" for i in range(int(rng.integers(5, 60)))]
        w = [*passages[j % 3], *own, *(passages[(j + 1) % 3][: int(rng.integers(0, 100))])]
        texts.append(" ".join(w))
        if j % 10 == 0:
            for at in rng.choice(len(w), 2, replace=False):
                w[at] = f"e{j}x{at}"
            texts.append(" ".join(w))
    return [*texts, "", "one", "one", "two words", "Two  WORDS", " "]


def test_boilerplate_against_brute_force(spark):
    texts = boilerplate(240)
    expected = groups(texts)[0]
    assert components(spark, texts) == expected
    # Passages as hot shingles: they come last in the order, by another path.
    assert components(spark, texts, hot_share=1e-3, hot_least=8) == expected


def test_candidates_do_not_grow_with_the_square(spark, monkeypatch):
    asked = []
    real = resemblance.verified
    monkeypatch.setattr(resemblance, "verified", lambda pairs, held, t: (asked.append(pairs.count()), real(pairs, held, t))[1])
    counts = []
    for n in (150, 600):
        asked.clear()
        base = [f"b{i}" for i in range(200)]
        rng, texts = np.random.default_rng(n), []
        for j in range(n):
            w = list(base)
            for at in rng.choice(200, 4, replace=False):
                w[at] = f"c{j}x{at}"
            texts += [" ".join(w), " ".join([*base[:100], *(f"u{j}x{i}" for i in range(70))])]
        texts.append(" ".join(base))
        got = components(spark, texts)
        assert len({got[2 * j] for j in range(n)}) == 1 and len(set(got)) == n + 1
        counts.append(sum(asked))
    assert counts[1] <= 6 * counts[0]


def test_counts_of_messages():
    rng = np.random.default_rng(1)
    pairs = [(int(t) << 40, int(s)) for t, s in zip(rng.integers(0, 200, 3000), rng.integers(1, 60, 3000), strict=True)]
    owners = {}
    for t, s in pairs:
        owners.setdefault(t, set()).add(s)
    expected = sorted((t, 0, s, len(x)) for t, x in owners.items() if len(x) > 1 for s in x)
    for n_buckets in (1, 7):
        rows = []
        for lo in range(0, 3000, 700):
            out = resemblance._Outbox(n_buckets)
            part = np.array(pairs[lo : lo + 700], dtype=np.uint64)
            out.add(part[:300, 0], part[:300, 1])
            out.add(part[300:, 0], part[300:, 1])
            out.facts(np.array([7], dtype=np.uint64), np.array([9], dtype=np.uint64))
            out.close_run()
            rows += out.take().to_pylist()
        rows.sort(key=lambda r: r["bucket"])
        batches = [pa.RecordBatch.from_pylist(rows[i : i + 3], schema=resemblance._Outbox(1).take().schema) for i in range(0, len(rows), 3)]
        got = [tuple(x.values()) for b in resemblance._counted(iter(batches)) for x in b.to_pylist()]
        assert sorted(x for x in got if x[1] == 0) == expected and [x for x in got if x[1]] == [(0, 7, 9, 0)] * 5


def test_one_row_of_each_group_stays(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a, "x"), (1, b, "x"), (2, a.upper(), "x"), (None, a, "x"), (3, a, "y"), (None, "lone words here", "z"), (None, "lone words here", "z"), (1, a, "x"), (4, None, "n"), (5, "", "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_key string")
    got = sorted(map(tuple, simhash.keep_one(docs).collect()), key=str)
    assert got == sorted([(1, a, "x"), (1, b, "x"), (None, "lone words here", "z"), (4, None, "n")], key=str)
    assert simhash.keep_one(docs.where("doc_id > 99")).count() == 0
