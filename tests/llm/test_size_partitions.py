"""Items of all sizes in documents of all sizes, against brute force; partitions that a document cannot hold are not probed."""

import random

import pyarrow as pa

from siftwell.llm import decontamination as D
from siftwell.llm import words as W


def corpus():
    rng = random.Random(6)
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in (1, 2, 4, 5, 7, 12, 30, 90, 400)]
    docs = []
    for item_id, text in items:
        w = text.split()
        for lost in (0, 1, len(w) // 30, len(w) // 8):
            kept = list(w)
            for at in rng.sample(range(len(w)), min(lost, len(w))):
                kept[at] = "other"
            docs.append(" ".join([*(f"d{rng.randrange(99)}" for _ in range(rng.randrange(200))), *kept, *(f"d{rng.randrange(99)}" for _ in range(rng.randrange(200)))]))
        docs.append(" ".join(w[: max(1, (9 * len(w)) // 10)]))
    return items, [*docs, "", "i5x0"]


def test_all_sizes_against_brute_force(spark):
    items, docs = corpus()
    expected = set()
    for i, text in enumerate(docs):
        own = D.words_of(text)
        for item_id, item in items:
            shingles = D.shingles_of(D.words_of(item))
            size = len(next(iter(shingles)))
            found = len(shingles & {tuple(own[k : k + size]) for k in range(len(own) - size + 1)})
            if found >= 0.8 * len(shingles) - 1e-9:
                expected.add((i, item_id, found))
    got = D.contaminated(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"], r["n_found"]) for r in got.collect()} == expected


def test_partitions_prune():
    items, _ = corpus()
    sketches = D.Sketches(items, 0.8, 5)
    assert len(sketches.partitions[5]) > 4 and [p.least for p in sketches.partitions[5]] == sorted(p.least for p in sketches.partitions[5])
    short, long = " ".join(items[-1][1].split()[:40]), items[-1][1]
    assert {doc for doc, _ in sketches.candidates(W.split(pa.array([short, long]), W.NOT_ALNUM))} == {1}
