"""Recall of the index at the registered and the default settings."""

import pytest

from siftwell import queries
from siftwell.operators import vectors


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_ivf_recall(spark, sf):
    d = f"/root/testdata/sf{sf}"
    items = queries._items(spark, d).cache()
    exact = {(r["image_id"], r["neighbor_id"]) for r in vectors.top_k(items, queries.FINAL_K).collect()}
    for name, got in (("registered", queries.QUERIES["ivf_topk"](spark, d)), ("default", vectors.top_k(items, queries.FINAL_K, "ivf"))):
        recall = len(exact & {(r["image_id"], r["neighbor_id"]) for r in got.collect()}) / len(exact)
        print(f"recall at sf{sf}, {name}: {recall:.4f}")
        assert recall >= 0.9
