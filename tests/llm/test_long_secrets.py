"""Opaque runs of any length are found, counted and masked."""

from siftwell.llm import secrets


def test_long_opaque_runs(spark):
    runs = ["aB3-" * 5, "aB3_" * 32, "aB3x" * 32 + "y", "Qw7" * 55, "zX9_" * 86, "kL2" * 2000]
    rows = [(i, f"see {run} there", f"s{i}") for i, run in enumerate(runs)] + [(10 + i, "shared " + "Ex4m" * 50, f"o{i}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs).collect()}
    assert all(got[i] == f"opaque:4:{4 + len(run)}" for i, run in enumerate(runs)) and not any(got[10 + i] for i in range(4))
    masked = {r["doc_id"]: r["text"] for r in secrets.mask(docs).collect()}
    assert all(masked[i] == f"see {'*' * len(run)} there" for i, run in enumerate(runs)) and "Ex4m" in masked[10]
