"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Items and documents are lower-cased; words are runs of ASCII letters and digits and of characters beyond ASCII. An item
is the set of its five-word shingles (an item of one to four words has its whole word sequence as its only shingle). A
document contains an item if at least ``threshold`` of the item's shingles occur in it.

Items are partitioned by size: a partition holds the items of one shingle length whose numbers of shingles have the same
power of two, with a sketch table and a least match of its own, the fewest shingles that any of its items needs. A
document is probed for the partitions only whose least match its windows reach. The sketch of n shingles keeps the
``n - ceil(threshold * n) + 1`` smallest min-hash values of an item. If a document holds ``threshold`` of an item's
shingles it misses at most ``n - ceil(threshold * n)`` of them, so at least one sketch value is among the document's:
the search has no false negatives, whatever the lengths. Signatures of whole documents could not find a short item in a
long document; each document is probed with every rolling window, whole, and candidates are then verified on the words.

The benchmark is the query set. It is read in blocks of at most ``block_items`` items and ``block_bytes`` bytes (a longer
item is a block of its own), the documents once per block, so what is sent to executors has a bound that does not depend
on the tables.

Null or empty texts, and items without words, match nothing; empty tables give an empty result (or all documents).
Repeated document rows give repeated result rows; an item id that occurs with several texts is searched for with each. A
null id stays null in the result. Extra columns of either table are ignored by ``contaminated`` and kept by
``decontaminate``, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import words as W
from siftwell.llm.tables import fresh, row_key, table, text_or_empty
from siftwell.plans.staging import stage

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20
_WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles_of(words: list[str], size: int = SHINGLE_WORDS) -> set[tuple[str, ...]]:
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def _lowered(texts: pa.Array) -> pa.Array:
    """As ``str.lower`` does it; Arrow's own function differs on a few letters."""
    data, _ = W.buffers(texts)
    if not (data >= 0x80).any():
        return pa.compute.ascii_lower(texts)
    return pa.array([t.lower() for t in texts.to_pylist()], pa.large_string())


def _windows(words: W.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows of ``size`` words begin, and their hashes."""
    sums = W.prefix_sums(words.hashes(), W.WORD_BASE)
    at = W.windows(words.first, size)
    return at, W.range_hashes(sums, at, at + size, W.WORD_BASE)


@dataclass
class Partition:
    """Items of about one size: the least match of any, and the sorted sketch values with the items that have each."""

    least: int
    values: np.ndarray
    holders: list[list[int]]


class Sketches:
    """The sketches of one block of items, by shingle length and by the power of two of the number of shingles."""

    def __init__(self, items: list[tuple[int | None, str | None]], threshold: float, size: int) -> None:
        self.items = []
        found: dict[tuple[int, int], dict[int, list[int]]] = {}
        least: dict[tuple[int, int], int] = {}
        for item_id, text in items:
            words = words_of(text)
            shingles = shingles_of(words, size)
            if not shingles:
                continue
            need = max(1, math.ceil(round(threshold * len(shingles), 9)))
            length = min(size, len(words))
            _, hashes = _windows(W.split(pa.array([" ".join(words)]), W.NOT_ALNUM), length)
            at = length, len(shingles).bit_length()
            least[at] = min(need, least.get(at, need))
            for value in np.unique(hashes)[: len(shingles) - need + 1].tolist():
                found.setdefault(at, {}).setdefault(value, []).append(len(self.items))
            self.items.append((item_id, shingles, need))
        self.partitions: dict[int, list[Partition]] = {}
        for at in sorted(found):
            values = sorted(found[at])
            self.partitions.setdefault(at[0], []).append(Partition(least[at], np.array(values, dtype=np.uint64), [found[at][v] for v in values]))
        self.any = {length: np.unique(np.concatenate([p.values for p in parts])) for length, parts in self.partitions.items()}

    def candidates(self, words: W.Words) -> set[tuple[int, int]]:
        """Pairs of a text's position and an item whose sketch meets it."""
        out = set()
        for length, parts in self.partitions.items():
            at, hashes = _windows(words, length)
            docs = np.searchsorted(words.first, at, "right") - 1
            room = np.maximum(np.diff(words.first) - length + 1, 0)
            hit = np.flatnonzero((room[docs] >= min(p.least for p in parts)) & W.member(hashes, self.any[length]))
            docs, hashes = docs[hit], hashes[hit]
            for part in parts:
                held = np.flatnonzero((room[docs] >= part.least) & W.member(hashes, part.values))
                slots = np.searchsorted(part.values, hashes[held])
                for doc, slot in set(zip(docs[held].tolist(), slots.tolist(), strict=True)):
                    out.update((doc, item) for item in part.holders[slot])
        return out

    def matches(self, texts: pa.Array) -> Iterator[tuple[int, int, int]]:
        """Position of the text, item, and how many of the item's shingles the text has; verified on the words."""
        for lo, hi in W.slices(texts):
            part = _lowered(texts.slice(lo, hi - lo))
            words = W.split(part, W.NOT_ALNUM)
            by_doc: dict[int, list[int]] = {}
            for doc, item in self.candidates(words):
                by_doc.setdefault(doc, []).append(item)
            for doc in sorted(by_doc):
                own = words_of(part[doc].as_py())
                sets = {}
                for item in sorted(by_doc[doc]):
                    _, shingles, need = self.items[item]
                    length = len(next(iter(shingles)))
                    if length not in sets:
                        sets[length] = {tuple(own[i : i + length]) for i in range(len(own) - length + 1)}
                    shared = len(shingles & sets[length])
                    if shared >= need:
                        yield lo + doc, item, shared


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    shingle_words: int = SHINGLE_WORDS,
    block_items: int = BLOCK_ITEMS,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row for each document row and item that it contains: doc_id, item_id, n_shingles, n_found, containment."""
    return _found(docs, benchmark, threshold, shingle_words, block_items, block_bytes, id_col, text_col).drop("row_key")


def _found(docs: DataFrame, benchmark: DataFrame, threshold: float, shingle_words: int, block_items: int, block_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """What ``contaminated`` returns, with the row's hash of id and text."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), row_key(F.col(id_col), text_or_empty(text_col)).alias("row_key"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    schema = "doc_id long, row_key long, item_id long, n_shingles long, n_found long, containment double"
    parts = []
    for block in _blocks(items, block_items, block_bytes):
        sent = spark.sparkContext.broadcast(Sketches(block, threshold, shingle_words))

        @W.frugal
        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sketches = sent.value
            for batch in batches:
                rows = list(sketches.matches(W.flat(batch.column(1))))
                held = [sketches.items[i] for _, i, _ in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(pa.array([d for d, _, _ in rows], pa.int64())) for c in (0, 2)),
                        pa.array([x[0] for x in held], pa.int64()),
                        pa.array([len(x[1]) for x in held], pa.int64()),
                        pa.array([n for _, _, n in rows], pa.int64()),
                        pa.array([n / len(x[1]) for (_, _, n), x in zip(rows, held, strict=True)], pa.float64()),
                    ],
                    names=["doc_id", "row_key", "item_id", "n_shingles", "n_found", "containment"],
                )

        parts.append(slim.mapInArrow(search, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _blocks(items: DataFrame, most_items: int, most_bytes: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items a block at a time; the driver holds one block."""
    block: list[tuple[int | None, str | None]] = []
    held = 0
    for row in items.toLocalIterator():
        width = len((row[1] or "").encode())
        if block and (len(block) == most_items or held + width > most_bytes):
            yield block
            block, held = [], 0
        block.append((row[0], row[1]))
        held += width
    if block:
        yield block


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    shingle_words: int = SHINGLE_WORDS,
    block_items: int = BLOCK_ITEMS,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents that contain no item, with the columns they had; rows that share an id are judged by their own texts."""
    key = fresh(docs, "hit_key")
    hits = _found(docs, benchmark, threshold, shingle_words, block_items, block_bytes, id_col, text_col).select(F.col("row_key").alias(key)).distinct()
    # Staged first, so that the planner knows whether the hits are few enough to be sent.
    return docs.withColumn(key, row_key(F.col(id_col), text_or_empty(text_col))).join(stage(hits, "hits"), key, "left_anti").select(*docs.columns)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-/:-@\[-`{-\x7f]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, text, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-/:-@\[-`{-\x7f]+') AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, text, least(5, len(w)) AS k, unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2),
  lambda p: array_to_string(w[p : p + least(5, len(w)) - 1], ' '))) AS s FROM b WHERE len(w) > 0),
n AS (SELECT item_id, text, count(*) AS n FROM i GROUP BY ALL),
k AS (SELECT DISTINCT k FROM i),
s AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p : p + k - 1], ' '))) AS s
  FROM d, k WHERE len(w) >= k),
m AS (SELECT doc_id, item_id, i.text, count(*) AS f FROM s JOIN i USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, f AS n_found, f / n::DOUBLE AS containment FROM m JOIN n USING (item_id, text)
WHERE f >= ceil(round(0.8 * n, 9))
"""
