"""Links of crowded subtries, by either way of parting them, against all pairs."""

import random

import pytest

from siftwell.llm import simhash
from siftwell.operators.graph import connected_components


def fingerprints():
    rng = random.Random(11)
    out = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            bits = centre
            for _ in range(rng.randrange(0, 7)):
                bits ^= 1 << rng.randrange(64)
            out.add(bits)
    base = rng.getrandbits(64) & ~0xFFF
    return sorted(out | {base | x for x in rng.sample(range(4096), 150)} | {rng.getrandbits(64) for _ in range(60)})


@pytest.mark.parametrize(("split_rows", "agree", "most_agree"), [(10**6, None, 6), (16, 1, 1), (16, 1, 3), (5, 2, 4), (40, 1, 6)])
def test_crowded_subtries(spark, split_rows, agree, most_agree):
    held = fingerprints()
    label = {x: x for x in held}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, x in enumerate(held):
        for y in held[:i]:
            if (x ^ y).bit_count() <= 4:
                a, b = root(x), root(y)
                label[max(a, b)] = min(a, b)
    expected = {}
    for x in held:
        expected.setdefault(root(x), set()).add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = spark.createDataFrame([(signed(x),) for x in held], "fp long")
    found = {}
    for r in connected_components(simhash.links(rows, len(held), 4, split_rows, agree, most_agree)).collect():
        found.setdefault(r["component"], set()).add(r["node"] % (1 << 64))
    assert sorted(map(sorted, found.values())) == sorted(sorted(x) for x in expected.values() if len(x) > 1) and len(found) > 8
