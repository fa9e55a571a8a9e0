"""The corpus pipeline: quality rules, SimHash near-dedup, benchmark decontamination, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and returns what goes on; its result is written as Parquet and read back as the
next stage's documents. Decisions take effect: rejected documents go, one document of each group of near duplicates
stays, documents with benchmark items go, secrets are masked, and what is left is packed.

Nulls and empty texts have fewer than 20 words, so quality rules drop them; a null id, language or source is a value like
any other, and a document without an id that holds a benchmark item takes the others without an id along. Ties and
repeated rows are near duplicates, of which one row stays. Texts of any length are read whole. Empty tables give an empty
table. Extra columns go through all stages but packing, whatever their names; packing returns its pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftwell.llm import decontamination, packing, quality_rules, secrets, simhash
from siftwell.llm.tables import table
from siftwell.plans.shipping import ship
from siftwell.plans.staging import scratch, stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality_rules.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secret scan", mask_secrets),
    ("packing", pack),
]

#: SQL has neither XXH64 nor the tokenizer; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        with scratch():
            docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
