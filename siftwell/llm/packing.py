"""Mixture-controlled packing: deficit round-robin over source queues.

Token sequences of all documents are packed into windows of ``window`` tokens so that the mixture of sources follows its
targets, by default each source's share of all tokens (so that all queues run dry together). The steps:

1. Texts are tokenized once and staged, each with how many tokens of its source its task had before it.
2. Sums by task and source give each document its place in its source's queue: the tokens before it. Lanes are equal
   ranges of each source's tokens, so a lane has the same part of every source, however the input was ordered, and a
   source that holds a third of all rows is spread over all lanes. A document on a border is part of both lanes.
3. A lane's task serves its queues by deficit round-robin: the source with the largest deficit sends up to a quantum,
   which is charged to it, while every token sent credits all sources with their targets. A lane begins with the deficits
   that all lanes before it have left, which follow from the places of its first documents; so deficits carry over
   windows and over tasks, and a source is off target by a few quanta at most in each window. A quantum is a small part
   of the window.
4. Lanes follow one another without a gap: a window may end one lane and begin the next. Only the corpus' last window
   can be short.

Documents are cut where a quantum, a window or a lane ends; each token lies in one piece. With ``weights`` the deficits follow
these instead; as all tokens are packed, the mixture then holds as far as the queues of a lane last.

Null texts count as empty and are packed as their end token alone; null sources are a queue of their own; a null id
stays null. Repeated rows are packed as often as they occur. Extra columns are ignored. The tokenizer's file is read on
the driver (a few MB) and sent to executors.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator, Mapping
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siftwell.llm import words as W
from siftwell.llm.tables import table, text_or_empty
from siftwell.plans.staging import stage

WINDOW = 2048
QUANTUM = 64
END_ID = 1
LANE_TOKENS = 1 << 20
#: Fixed value: how byte-level tokenizers cut texts before merging.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Token ids of texts, by the tokenizer that a ``tokenizers`` file describes.

    A byte-level BPE whose merges rank as its ids do is run by tiktoken, which gives the same ids in a third of the
    time; any other tokenizer, and any text that holds the string of an added token, is run by ``tokenizers`` itself.
    """

    def __init__(self, json_text: str) -> None:
        spec = json.loads(json_text)
        self.json_text = json_text
        self.added = [x["content"] for x in spec.get("added_tokens", [])]
        self.ranks = self._ranks(spec)

    @cached_property
    def tokenizer(self) -> Tokenizer:
        return Tokenizer.from_str(self.json_text)

    @cached_property
    def ranked(self) -> tiktoken.Encoding | None:
        return self.ranks and tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    def __reduce__(self) -> tuple:
        """What is sent has the ranks made, so that a worker holds no parsed file, and makes either tokenizer when it needs it."""
        return _encoder_of, (self.json_text, self.added, self.ranks)

    @staticmethod
    def _ranks(spec: dict) -> dict[bytes, int] | None:
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if spec.get("normalizer") or model["type"] != "BPE" or any(before.get(k) != v for k, v in plain.items()):
            return None
        if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            return None
        vocab, merges = model["vocab"], model["merges"]
        merged = [vocab["".join(x if isinstance(x, list) else x.split(" "))] for x in merges]
        if merged != sorted(merged) or (merged and merged[0] < 256):
            return None
        shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        added = {x["content"] for x in spec.get("added_tokens", [])}
        return {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in added}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text."""
        if self.ranked:
            return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids if any(x in t for x in self.added) else self.ranked.encode_ordinary(t), dtype=np.uint32) for t in texts]
        return [np.array(x.ids, dtype=np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _encoder_of(json_text: str, added: list[str], ranks: dict[bytes, int] | None) -> Encoder:
    made = Encoder.__new__(Encoder)
    made.json_text, made.added, made.ranks = json_text, added, ranks
    return made


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, task, before (tokens of the source earlier in the task), n_tokens, held (compressed ids)."""
    sent = docs.sparkSession.sparkContext.broadcast(Encoder(Path(tokenizer_path).read_text(encoding="utf-8")))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), text_or_empty(text_col).alias("text"))

    @W.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task, served = sent.value, TaskContext.get().partitionId(), {}
        end, press = np.array([end_id], dtype=np.uint32), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids = [np.concatenate((x, end)) for x in own.encode(part.column(2).to_pylist())]
                before = []
                for source, x in zip(part.column(1).to_pylist(), ids, strict=True):
                    before.append(served.get(source, 0))
                    served[source] = before[-1] + len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([task] * len(ids), pa.int32()),
                        pa.array(before, pa.int64()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([press.compress(_planes(x)) for x in ids], pa.binary()),
                    ],
                    names=["doc_id", "source", "task", "before", "n_tokens", "held"],
                )

    return slim.mapInArrow(run, "doc_id long, source string, task int, before long, n_tokens long, held binary")


def _planes(ids: np.ndarray) -> bytes:
    """16 bits for each id, or 32 if any needs them, after a byte that says which."""
    return b"\2" + ids.astype(np.uint16).tobytes() if ids.max(initial=0) < 1 << 16 else b"\4" + ids.tobytes()


def _ids(held: bytes) -> np.ndarray:
    raw = zstandard.decompress(held)
    return np.frombuffer(raw, dtype=np.uint16 if raw[0] == 2 else np.uint32, offset=1).astype(np.uint32)


def serve(queues: dict[str, list[int]], sizes: list[int], targets: Mapping[str, float], deficits: Mapping[str, float], quantum: int) -> Iterator[tuple[int, int, int]]:
    """Deficit round-robin over queues of documents: document, first token and number of tokens of each piece in turn.

    A source's deficit is its target share of what was sent so far, less what it sent itself. As every source's credit
    grows with the same clock, the largest deficit in units of the target is the earliest due time, kept in a heap.
    """
    sent = {s: -deficits[s] for s in queues}
    heap = [(sent[s] / targets[s], s) for s in queues]
    heapq.heapify(heap)
    head = dict.fromkeys(queues, 0)
    done = dict.fromkeys(queues, 0)
    while heap:
        _, source = heapq.heappop(heap)
        doc = queues[source][head[source]]
        take = min(quantum, sizes[doc] - done[source])
        yield doc, done[source], take
        done[source] += take
        sent[source] += take
        if done[source] == sizes[doc]:
            head[source] += 1
            done[source] = 0
        if head[source] < len(queues[source]):
            heapq.heappush(heap, (sent[source] / targets[source], source))


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def _pack(lane: pa.Table, window: int, quantum: int) -> pa.Table:
    lane = lane.sort_by([("source", "ascending"), ("start_of", "ascending"), ("doc_id", "ascending")])
    doc_ids, sources, sizes = (lane.column(c).to_pylist() for c in ("doc_id", "source", "n_tokens"))
    start_of, target, skipped, doc_tokens = (lane.column(c).to_pylist() for c in ("start_of", "target", "skipped", "doc_tokens"))
    at = lane.column("lane_start")[0].as_py()
    queues: dict[str, list[int]] = {}
    for i, s in enumerate(sources):
        queues.setdefault(s, []).append(i)
    targets = {s: target[q[0]] for s, q in queues.items()}
    deficits = {s: targets[s] * at - start_of[q[0]] for s, q in queues.items()}
    held = lane.column("held")
    open_: dict[int, np.ndarray] = {}
    rows: list[tuple] = []
    for doc, first, take in serve(queues, sizes, targets, deficits, quantum):
        ids = open_.pop(doc, None)
        if ids is None:
            ids = _ids(held[doc].as_py())[skipped[doc] : skipped[doc] + sizes[doc]]
        if first + take < sizes[doc]:
            open_[doc] = ids
        while take:
            n = min(take, window - at % window)
            rows.append((doc_ids[doc], skipped[doc] + first, n, zlib.crc32(ids[first : first + n].tobytes()), doc_tokens[doc], at // window, at % window, sources[doc]))
            first, take, at = first + n, take - n, at + n
    kinds = [pa.int64()] * 7 + [pa.string()]
    names = [x.split()[0] for x in PIECES.split(", ")]
    return pa.table({name: pa.array(c, kind) for name, kind, c in zip(names, kinds, zip(*rows, strict=True), strict=True)})


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    quantum: int = QUANTUM,
    end_id: int = END_ID,
    weights: Mapping[str, float] | None = None,
    lane_tokens: int = LANE_TOKENS,
    **columns,
) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source."""
    spark = docs.sparkSession
    tokens = stage(tokenize(docs, tokenizer_path, end_id, **columns), "tokens")
    by_task = stage(tokens.groupBy("task", "source").agg(F.sum("n_tokens").alias("n")), "by_task")
    by_source = stage(by_task.groupBy("source").agg(F.sum("n").alias("source_tokens")), "by_source")
    total = by_source.agg(F.sum("source_tokens")).first()[0] or 0
    if not total:
        return spark.createDataFrame([], PIECES)
    n_lanes = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // lane_tokens))
    n_lanes = min(n_lanes, max(1, total // window))
    share = F.col("source_tokens") / F.lit(total)
    if weights:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        share = F.greatest(F.coalesce(given[F.col("source")], F.lit(0.0)), F.lit(1e-9))
    earlier = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    offsets = stage(offsets.join(by_source.withColumn("target", share), "source"), "offsets")
    start = F.col("earlier") + F.col("before")
    lane_of = lambda at: F.expr(f"(({at} + 1) * {n_lanes} - 1) div source_tokens")
    edge = lambda lane: F.expr(f"({lane} * source_tokens) div {n_lanes}")

    def cut(rows: DataFrame) -> DataFrame:
        """A row for each lane that a document has tokens in, with those tokens' place and number."""
        whole = rows.join(offsets, ["task", "source"]).withColumn("doc_start", start).withColumnRenamed("n_tokens", "doc_tokens")
        each = whole.withColumn("lane", F.explode(F.sequence(lane_of("doc_start"), lane_of("(doc_start + doc_tokens - 1)"))))
        each = each.withColumn("start_of", F.greatest("doc_start", edge("lane"))).withColumn("skipped", F.col("start_of") - F.col("doc_start"))
        return each.withColumn("n_tokens", F.least(F.col("doc_start") + F.col("doc_tokens"), edge("(lane + 1)")) - F.col("start_of"))

    placed = cut(tokens).select("doc_id", "source", "n_tokens", "held", "target", "start_of", "skipped", "doc_tokens", "lane")
    lanes = cut(tokens.drop("held", "doc_id")).groupBy("lane").agg(F.sum("n_tokens").alias("n"))
    starts = _running(stage(lanes, "lanes"))
    joined = placed.join(starts, "lane")

    def packed(rows: pa.Table) -> pa.Table:
        out = _pack(rows, window, quantum)
        W.release()
        return out

    return joined.groupBy("lane").applyInArrow(packed, PIECES)


def _running(lanes: DataFrame, block: int = 4096) -> DataFrame:
    """lane, lane_start: sums of n over earlier lanes, in two levels so that no window holds all lanes."""
    marked = lanes.withColumn("block", F.floor(F.col("lane") / block))
    inner = Window.partitionBy("block").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(F.lit(0)).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = marked.groupBy("block").agg(F.sum("n").alias("n")).select("block", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("earlier"))
    placed = marked.withColumn("inside", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(blocks, "block")
    return stage(placed.select("lane", (F.col("earlier") + F.col("inside")).alias("lane_start")), "starts")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
