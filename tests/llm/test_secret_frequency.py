"""The ownership verdict against counts by hand, and masks over blocks against a slice of the text."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from siftwell.llm import secrets

VALUES = [f"Tok{i}en-" + "aB3" * 6 for i in range(12)]


def corpus():
    rng, rows = random.Random(4), []
    for i, value in enumerate(VALUES):
        for j in range(1 + i % 5):
            owner = f"o{rng.randrange(1 + i % 3)}" if i % 4 else None
            rows.append((len(rows), f"see {value} and {value} here", f"{owner}/r{rng.randrange(3)}", owner, "x"))
    return [*rows, rows[0], rows[5]]


def test_frequency_verdicts(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, repo string, owner string, row string")
    repos, owners = defaultdict(set), defaultdict(set)
    for _, text, repo, owner, _ in rows:
        repos[text.split()[1]].add(repo)
        owners[text.split()[1]].add(owner)
    live = {v for v in repos if len(repos[v]) <= 2 and len(owners[v]) <= 1}
    assert 0 < len(live) < len(repos) and any(len(repos[v]) > 2 and len(owners[v]) == 1 for v in repos) and any(len(repos[v]) <= 2 and len(owners[v]) > 1 for v in repos)
    for hot_least in (1, 3, 1 << 16):
        found = secrets.scan(docs, repo_col="repo", owner_col=F.col("owner"), hot_share=0.0, hot_least=hot_least).collect()
        assert len(found) == len(rows)
        for r in found:
            text = rows[r["doc_id"]][1]
            assert (r["n_live"], bool(r["spans"])) == ((2, True) if text.split()[1] in live else (0, False))
    masked = secrets.mask(docs, repo_col="repo", owner_col="owner").collect()
    for r in masked:
        value = rows[r["doc_id"]][1].split()[1]
        assert r["text"] == rows[r["doc_id"]][1].replace(value, "*" * len(value) if value in live else value)
    assert sorted(map(tuple, (r[:1] + r[2:] for r in masked)), key=str) == sorted((r[:1] + r[2:] for r in rows), key=str)


def test_masks_in_long_texts(spark):
    rng, text, expected = random.Random(8), "", ""
    for i in range(3000):
        plain = "é😀 w" * rng.randrange(1, 9) + " token="
        secret = f"{rng.getrandbits(64):016x}" * 3
        text += plain + secret
        expected += plain + "*" * len(secret)
    docs = spark.createDataFrame([(1, text, "s", 5), (2, None, None, None), (3, "", "s", 0), (4, "plain", "s", 5)], "doc_id long, text string, source string, n_chars int")
    got = {r["doc_id"]: r for r in secrets.mask(docs).collect()}
    assert got[1]["text"] == expected and got[1]["n_chars"] == len(expected)
    assert got[2]["text"] is None and got[3]["text"] == "" and got[4]["text"] == "plain" and got[4]["n_chars"] == 5
    assert {r["doc_id"]: r["n_assign"] for r in secrets.scan(docs).collect()} == {1: 3000, 2: 0, 3: 0, 4: 0}
