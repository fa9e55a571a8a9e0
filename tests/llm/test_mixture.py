"""The mixture of every window, hot sources and long documents included."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

from siftwell.llm import packing


def test_every_window_is_near_the_targets(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else f"s{i % 7}"
        n = 12000 if i % 60 == 1 else int(rng.integers(5, 900))
        rows.append((i, " ".join(f"w{x}" for x in rng.integers(0, 3000, n)), source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), lane_tokens=100_000).collect()
    windows, all_ = defaultdict(Counter), Counter()
    for r in got:
        windows[r["sequence_id"]][r["source"]] += r["length"]
        all_[r["source"]] += r["length"]
    total, last = sum(all_.values()), max(windows)
    assert {sum(w.values()) for i, w in windows.items() if i != last} == {2048} and last > 100
    worst = max(abs(w[s] / 2048 - n / total) for i, w in windows.items() if i != last for s, n in all_.items())
    print(f"largest deviation {worst:.4f} in {len(windows)} windows")
    assert worst <= 0.07
