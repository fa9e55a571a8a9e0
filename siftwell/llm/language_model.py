"""Language-model scoring: a bigram model in sharded Elias-Fano tries, trained and queried in one plan.

The model is p(w | h) = c(h, w) / (c(h) + m) + m / (c(h) + m) * (c(w) + 1) / (N + V + 1): counts of the training texts,
smoothed by interpolation with the add-one unigram. The first term is what the trie holds, in 255 levels of its
logarithm; the second is exact. Each text begins in a start context and ends in an end token.

Neither vocabulary nor n-grams are ever in one place:

1. Rows are dealt into chunks by a hash of their place and id, so that rows that are all the same are dealt apart. A chunk sends its distinct words with their training counts to the words'
   buckets, of which there are a quarter as many as chunks; a bucket sums, numbers its training words, and answers each
   chunk that asked with counts and numbers. Totals are summed over buckets and sent to each chunk once.
2. A chunk sends its distinct bigrams of known words to the bigrams' shards, by context. A frequent context is cut into
   parts by its successors, in proportion to its count, so no shard is much larger than another. The shard builds its
   trie from the training counts, memory-mapped in the task's temporary folder, looks up every bigram that was sent by
   successor search within its context, and answers with one byte for each.
3. The chunk adds up its texts' scores.

All counts are over all rows. What is sent is distinct per chunk and compressed, and nothing is sent where there is
nothing to say, so messages never outnumber distinct words and bigrams of chunks; all uses of the texts read one exchange.

Null texts count as empty (they are one end token). A null id is not held out, as it has no remainder. Repeated rows are
counted and scored as often as they occur. Texts of any length are read whole, each in one task. Without any training text
all counts are zero; an empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import words as W
from siftwell.llm.elias_fano import Trie
from siftwell.llm.substring_dedup import by_bucket, packed, unpacked
from siftwell.llm.tables import row_key, table, text_or_empty
from siftwell.plans.staging import partitions_for

CHUNK_BYTES = 8 << 20
#: Chunks' worth of texts whose words or bigrams one bucket holds.
BUCKETS_EACH = 4
SMOOTHING = 500.0
FOLDS, HELD_FOLD = 7, 2
END = W.mix(np.array([0x454E44], dtype=np.uint64))[0]
LEVELS, LOWEST = 255, -12.0
_ID_BITS = 40
_MESSAGE = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("stage", pa.int32()), ("keys", pa.binary()), ("numbers", pa.binary()), ("extra", pa.binary()), ("total", pa.int64())])
_WORDS, _PAIRS, _TOTALS = range(3)
MESSAGE = "part int, chunk int, stage int, keys binary, numbers binary, extra binary, total long"


def _plain(values: np.ndarray) -> bytes:
    """64-bit values byte plane by byte plane, compressed; small values cost little."""
    return zstandard.compress(np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _plain_back(held: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(held), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel()


def _messages(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(_MESSAGE)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _MESSAGE, strict=True)], schema=_MESSAGE)


def code_of(probability: np.ndarray) -> np.ndarray:
    """1 to 255 for probabilities from 10**LOWEST to 1."""
    return np.clip(np.rint((np.log10(probability) / LOWEST) * (LEVELS - 1)), 0, LEVELS - 1).astype(np.uint8) + np.uint8(1)


VALUE_OF = np.concatenate(([0.0], 10.0 ** (LOWEST * np.arange(LEVELS) / (LEVELS - 1))))


@dataclass
class Chunk:
    """Tokens of a chunk's texts as places in its sorted distinct word hashes."""

    chunk: int
    vocabulary: np.ndarray
    trained: np.ndarray
    tokens: np.ndarray
    first: np.ndarray
    in_training: np.ndarray

    @staticmethod
    def of(group: pa.Table) -> Chunk:
        held_out = group.column("held_out").to_numpy()
        texts, hashes, lengths = W.flat(group.column("text")), [], []
        for lo, hi in W.slices(texts):
            words = W.split(texts.slice(lo, hi - lo), lower=True)
            n = np.diff(words.first)
            own = np.full(len(words.starts) + len(n), END, dtype=np.uint64)
            own[np.arange(len(words.starts)) + words.doc_of_word()] = words.hashes()
            hashes.append(own)
            lengths.append(n + 1)
        all_, n = np.concatenate(hashes), np.concatenate(lengths)
        vocabulary = np.sort(all_)
        vocabulary = vocabulary[np.concatenate(([True], vocabulary[1:] != vocabulary[:-1]))]
        tokens = np.searchsorted(vocabulary, all_)
        trains = np.repeat(~held_out, n)
        trained = np.bincount(tokens[trains], minlength=len(vocabulary))
        return Chunk(group.column("chunk")[0].as_py(), vocabulary, trained, tokens, np.concatenate(([0], np.cumsum(n))), trains)


def ask_words(group: pa.Table, n_parts: int) -> pa.Table:
    """To each bucket that has any of the chunk's words: the words and their training counts."""
    own = Chunk.of(group)
    return _messages([(k, own.chunk, _WORDS, packed(own.vocabulary[a:b]), _plain(own.trained[a:b]), None, None) for k, a, b in by_bucket(own.vocabulary, n_parts)])


def answer_words(bucket: pa.Table) -> pa.Table:
    """Counts, and numbers of the words that training has, to each chunk."""
    keys = [unpacked(x) for x in bucket.column("keys").to_pylist()]
    counts = [_plain_back(x) for x in bucket.column("numbers").to_pylist()]
    every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(every), dtype=np.uint64)
    np.add.at(sums, inverse, np.concatenate(counts))
    numbers = np.cumsum(sums > 0).astype(np.uint64) - (sums > 0)
    part = bucket.column("part")[0].as_py()
    rows, at = [], 0
    for chunk, mine in zip(bucket.column("chunk").to_pylist(), keys, strict=True):
        here = inverse[at : at + len(mine)]
        at += len(mine)
        known = here[sums[here] > 0]
        rows.append((part, chunk, _WORDS, _plain(sums[here]), packed(numbers[known]) if len(known) else b"", None, None))
    return _messages(rows)


def bucket_totals(bucket: pa.Table) -> pa.Table:
    """Training tokens and distinct training words of a bucket."""
    words = [unpacked(x)[_plain_back(c) > 0] for x, c in zip(bucket.column("keys").to_pylist(), bucket.column("numbers").to_pylist(), strict=True)]
    n = sum(int(_plain_back(c).sum()) for c in bucket.column("numbers").to_pylist())
    return pa.table([pa.array([n], pa.int64()), pa.array([len(np.unique(np.concatenate(words)))], pa.int64())], names=["n", "v"])


@dataclass
class Known:
    """What the buckets know of a chunk's words: counts, numbers (by place; 0 counts have none); and the corpus' totals."""

    counts: np.ndarray
    numbers: np.ndarray
    n: int
    v: int

    @staticmethod
    def of(replies: list[dict]) -> Known:
        answers = sorted((x for x in replies if x["stage"] == _WORDS), key=lambda x: x["part"])
        totals = next(x for x in replies if x["stage"] == _TOTALS)
        counts = np.concatenate([_plain_back(x["keys"]) for x in answers]).astype(np.int64)
        found = [unpacked(x["numbers"]) + np.uint64(x["part"] << _ID_BITS) for x in answers if x["numbers"]]
        numbers = np.zeros(len(counts), dtype=np.uint64)
        if found:
            numbers[counts > 0] = np.concatenate(found)
        return Known(counts, numbers, totals["total"], int.from_bytes(totals["extra"], "big"))


@dataclass
class Bigrams:
    """Distinct bigrams of known words of a chunk, sorted by shard and then by key (context place, word place)."""

    shard: np.ndarray
    context: np.ndarray
    word: np.ndarray
    trained: np.ndarray
    place: np.ndarray
    context_counts: np.ndarray

    @staticmethod
    def of(own: Chunk, known: Known, n_parts: int) -> Bigrams:
        size = len(own.vocabulary)
        end = int(np.searchsorted(own.vocabulary, END))
        before = np.empty(len(own.tokens), dtype=np.int64)
        before[1:] = own.tokens[:-1]
        before[own.first[:-1]] = size
        context_counts = np.append(known.counts, known.counts[end])
        both = (context_counts[before] > 0) & (known.counts[own.tokens] > 0)
        keys = (before.astype(np.uint64) * np.uint64(size) + own.tokens.astype(np.uint64)) * np.uint64(2) + own.in_training.astype(np.uint64)
        ordered = np.sort(keys[both])
        keys = ordered >> np.uint64(1)
        new = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), dtype=bool), keys[1:] != keys[:-1])))
        trained = np.add.reduceat((ordered & np.uint64(1)).astype(np.int64), new) if len(new) else np.zeros(0, dtype=np.int64)
        keys = keys[new]
        context, word = (keys // np.uint64(size)).astype(np.int64), (keys % np.uint64(size)).astype(np.int64)
        numbers = np.append(known.numbers, np.uint64(0xFFFF << 47))
        parts = np.maximum(1, -(-context_counts * n_parts * 4 // max(known.n, 1))).astype(np.uint64)
        salt = W.mix(known.numbers[word]) % parts[context]
        shard = (W.mix(numbers[context] + salt * np.uint64(W.WORD_BASE_2)) % np.uint64(n_parts)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        places = np.full(len(own.tokens), -1, dtype=np.int64)
        at = np.searchsorted(keys, before[both].astype(np.uint64) * np.uint64(size) + own.tokens[both].astype(np.uint64))
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        places[both] = back[at]
        return Bigrams(shard[order], context[order], word[order], trained[order], places, context_counts)

    def ranges(self) -> Iterator[tuple[int, int, int]]:
        new = np.flatnonzero(np.concatenate((np.ones(min(1, len(self.shard)), dtype=bool), self.shard[1:] != self.shard[:-1])))
        for a, b in zip(new.tolist(), [*new[1:].tolist(), len(self.shard)], strict=True):
            yield int(self.shard[a]), a, b


def ask_bigrams(group: pa.Table, answers: pa.Table, n_parts: int) -> pa.Table:
    """To each shard: contexts with their counts and numbers of successors; successors; training counts."""
    if not group.num_rows:
        return _messages([])
    own, known = Chunk.of(group), Known.of(answers.to_pylist())
    pairs = Bigrams.of(own, known, n_parts)
    numbers = np.append(known.numbers, np.uint64(0xFFFF << 47))
    rows = []
    for shard, a, b in pairs.ranges():
        context, words = pairs.context[a:b], known.numbers[pairs.word[a:b]]
        new = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
        heads = context[new]
        widths = np.diff(np.append(new, len(context)))
        steps = words.copy()
        steps[1:] -= words[:-1]
        steps[new] = words[new]
        meta = _plain(np.concatenate((widths.astype(np.uint64), pairs.context_counts[heads].astype(np.uint64))))
        rows.append((shard, own.chunk, _PAIRS, packed(numbers[heads]), meta, _plain(np.concatenate((steps, pairs.trained[a:b].astype(np.uint64)))), None))
    return _messages(rows)


def answer_bigrams(shard: pa.Table, smoothing: float) -> pa.Table:
    """Builds the shard's trie from the training counts, and looks up every bigram that was sent."""
    sent = []
    for keys, meta, extra in zip(*(shard.column(c).to_pylist() for c in ("keys", "numbers", "extra")), strict=True):
        heads, meta, extra = unpacked(keys), _plain_back(meta), _plain_back(extra)
        widths, counts = meta[: len(heads)].astype(np.int64), meta[len(heads) :]
        steps, trained = extra[: len(extra) // 2], extra[len(extra) // 2 :]
        running = np.cumsum(steps, dtype=np.uint64)
        starts = np.cumsum(widths) - widths
        words = running - np.repeat(np.where(starts > 0, running[np.maximum(starts - 1, 0)], np.uint64(0)), widths)
        sent.append((heads, widths, counts, words, trained))
    heads, counts = np.concatenate([x[0] for x in sent]), np.concatenate([x[2] for x in sent])
    contexts, at = np.unique(heads, return_index=True)
    counts = counts[at].astype(np.float64)
    ids = np.unique(np.concatenate([x[3][x[4] > 0] for x in sent]))
    n_ids = max(1, len(ids))
    local = [(np.searchsorted(contexts, x[0]), np.searchsorted(ids, x[3])) for x in sent]
    keys, weights = [], []
    for (heads, widths, _, _, trained), (rank, word) in zip(sent, local, strict=True):
        have = trained > 0
        keys.append((np.repeat(rank, widths) * n_ids + word)[have])
        weights.append(trained[have].astype(np.int64))
    keys, weights = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), dtype=bool), keys[1:] != keys[:-1])))
    weights = np.add.reduceat(weights, new) if len(new) else weights
    keys = keys[new]
    of = keys // n_ids
    trie = Trie(
        np.arange(len(contexts), dtype=np.uint64),
        np.searchsorted(of, np.arange(len(contexts) + 1)),
        keys % n_ids,
        code_of(weights / (counts[of] + smoothing)),
        n_ids,
    )
    rows = []
    part = shard.column("part")[0].as_py()
    for chunk, (_, widths, _, words, _), (rank, word) in zip(shard.column("chunk").to_pylist(), sent, local, strict=True):
        known = ids[np.minimum(word, n_ids - 1)] == words if len(ids) else np.zeros(len(words), dtype=bool)
        ranks = np.where(known, np.repeat(trie.rank(rank.astype(np.uint64)), widths), -1)
        rows.append((part, chunk, _PAIRS, zstandard.compress(trie.lookup(ranks, word).tobytes(), 1), None, None, None))
    trie.close()
    return _messages(rows)


def score(group: pa.Table, answers: pa.Table, n_parts: int, smoothing: float) -> pa.Table:
    if not group.num_rows:
        return RESULT.empty_table()
    replies = answers.to_pylist()
    own, known = Chunk.of(group), Known.of(replies)
    pairs = Bigrams.of(own, known, n_parts)
    codes = [np.frombuffer(zstandard.decompress(x["keys"]), dtype=np.uint8) for x in sorted((x for x in replies if x["stage"] == _PAIRS), key=lambda x: x["part"])]
    codes = np.concatenate([*codes, np.zeros(1, dtype=np.uint8)])
    size = float(known.n + known.v + 1)
    unigram = (known.counts[own.tokens] + 1) / size
    before = np.empty(len(own.tokens), dtype=np.int64)
    before[1:] = own.tokens[:-1]
    before[own.first[:-1]] = len(own.vocabulary)
    seen = pairs.context_counts[before]
    probability = VALUE_OF[codes[pairs.place]] + smoothing / (seen + smoothing) * unigram
    starts = own.first[:-1]
    add = lambda x: np.add.reduceat(x, starts)
    n = np.diff(own.first)
    base = add(np.log10(known.counts[own.tokens] + 1.0)) - n * math.log10(size)
    return pa.table(
        [
            group.column("doc_id"),
            group.column("held_out"),
            pa.array(n),
            pa.array(add((known.counts[own.tokens] > 0).astype(np.int64))),
            pa.array(np.full(len(n), known.n)),
            pa.array(base),
            pa.array(add(np.log10(np.minimum(probability, 1.0)))),
        ],
        schema=RESULT,
    )


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def score_texts(docs: DataFrame, smoothing: float = SMOOTHING, chunk_bytes: int = CHUNK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    n, parts = partitions_for(docs, chunk_bytes), partitions_for(docs, BUCKETS_EACH * chunk_bytes)
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_FOLD, F.lit(False))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), text_or_empty(text_col).alias("text"))
    dealt = slim.select(F.pmod(row_key(F.monotonically_increasing_id(), F.col("doc_id")), F.lit(n)).cast("int").alias("chunk"), "doc_id", "held_out", "text")
    asked = dealt.groupBy("chunk").applyInArrow(lambda t: ask_words(t, parts), MESSAGE)
    words = asked.groupBy("part").applyInArrow(answer_words, MESSAGE)
    sums = asked.groupBy("part").applyInArrow(bucket_totals, "n long, v long").agg(F.sum("n").alias("total"), F.sum("v").alias("v")).where("total IS NOT NULL")
    none = F.lit(None).cast("binary")
    each = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("chunk")
    totals = sums.select(F.lit(-1).alias("part"), each, F.lit(_TOTALS).alias("stage"), none.alias("keys"), none.alias("numbers"), F.unhex(F.lpad(F.hex("v"), 16, "0")).alias("extra"), "total")
    words = words.unionByName(totals)
    pairs = dealt.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(lambda t, r: ask_bigrams(t, r, parts), MESSAGE)
    codes = pairs.groupBy("part").applyInArrow(lambda t: answer_bigrams(t, smoothing), MESSAGE)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("chunk").cogroup(words.unionByName(codes).groupBy("chunk")).applyInArrow(lambda t, r: score(t, r, parts, smoothing), schema)


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
