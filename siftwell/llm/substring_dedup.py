"""Substring dedup: fixed-block anchors find every repeated window of 35 words, corpus-wide.

Every document is cut into non-overlapping blocks of B words, the anchors; with 2 * B - 1 <= window, each window holds a
whole block of its own document, so of two equal windows each meets an anchor of the other among its rolling B-word
windows. The steps:

1. Rows are dealt into chunks by a hash of their place and id, so that rows that are all the same are dealt apart. A chunk's task hashes every rolling B-word window of its texts and sends each
   distinct hash once to the hash's bucket, with two flags: it is an anchor here; it occurs here more than once.
2. A bucket indexes the anchors and probes them with all rolling windows. A hash that has an anchor and occurs at least
   twice is a hit, and is returned to the chunks that sent it.
3. The chunk extends its hits: each 35-word window that covers a hit is a candidate, and the distinct hashes (80 bits)
   of the candidates go to buckets again. Runs of windows that turn out repeated are the maximal exact repeats.
4. Windows that two or more places share come back, and the chunk cuts the words they cover.

What is sent per chunk is distinct, so a passage that a third of all rows share costs one entry in each chunk, never a
pair of rows. There are a quarter as many buckets as chunks, and nothing is sent where there is nothing to say, so messages
never outnumber the distinct windows of chunks. No window is dropped or sampled. Every use of the texts reads one exchange.

Null texts count as empty. A text shorter than the window keeps all its words. Of rows that are repeated, all lose the
windows they share: nothing is kept as a first copy, as windows are judged on the input. Whatever the order of the
rows, results are the same. Texts of any length are read whole, each in one task; an empty table gives an empty result.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import words as W
from siftwell.llm.tables import row_key, table, text_or_empty
from siftwell.plans.staging import partitions_for

WINDOW = 35
CHUNK_BYTES = 8 << 20
#: Chunks' worth of texts whose windows one bucket holds.
BUCKETS_EACH = 4
SENT = "bucket int, chunk int, held binary"
BACK = "chunk int, held binary"


def packed(values: np.ndarray) -> bytes:
    """A sorted array of 64-bit values, as compressed differences."""
    steps = values.copy()
    steps[1:] -= values[:-1]
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(held: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(held), dtype=np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def by_bucket(values: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """Bucket and range of each bucket that has some of the sorted values; buckets are equal ranges of their upper halves."""
    bucket = ((values >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(values)), dtype=bool), bucket[1:] != bucket[:-1])))
    yield from zip(bucket[starts].tolist(), starts.tolist(), [*starts.tolist(), len(values)][1:], strict=True)


def _batch(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns, strict=True)})


def _rolling(words: W.Words, size: int, base: int = W.WORD_BASE, hashes: np.ndarray | None = None) -> np.ndarray:
    at = W.windows(words.first, size)
    return W.range_hashes(W.prefix_sums(words.hashes() if hashes is None else hashes, base), at, at + size, base)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted values, and whether each occurs twice or more."""
    ordered = np.sort(values)
    new = np.concatenate((np.ones(min(1, len(ordered)), dtype=bool), ordered[1:] != ordered[:-1]))
    at = np.flatnonzero(new)
    return ordered[at], np.diff(np.append(at, len(ordered))) > 1


def _texts(group: pa.Table) -> Iterator[tuple[int, W.Words]]:
    texts = W.flat(group.column("text"))
    for lo, hi in W.slices(texts):
        yield lo, W.split(texts.slice(lo, hi - lo))


def probes(group: pa.Table, block: int, n_buckets: int) -> pa.Table:
    """Step 1. The two lowest bits of a sent value are its flags: anchor, occurs more than once."""
    rolling, anchors = [], []
    for _, words in _texts(group):
        at = W.windows(words.first, block)
        hashes = _rolling(words, block)
        own = words.first[np.searchsorted(words.first, at, "right") - 1]
        rolling.append(hashes)
        anchors.append(hashes[(at - own) % block == 0])
    if not sum(map(len, rolling)):
        return _batch(SENT, [])
    four = np.uint64(4)
    values, more = _distinct(np.concatenate(rolling) // four)
    flagged = values * four + W.member(values, np.unique(np.concatenate(anchors) // four)).astype(np.uint64) + more.astype(np.uint64) * np.uint64(2)
    chunk = group.column("chunk")[0].as_py()
    return _batch(SENT, [(k, chunk, packed(flagged[a:b])) for k, a, b in by_bucket(flagged, n_buckets)])


def hits(bucket: pa.Table) -> pa.Table:
    """Step 2: the values that have an anchor and occur twice or more, to each chunk that sent them."""
    sent = [unpacked(x) for x in bucket.column("held").to_pylist()]
    four = np.uint64(4)
    ordered = np.sort(np.concatenate(sent))
    values = ordered // four
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    flags = np.bitwise_or.reduceat(ordered & np.uint64(3), starts)
    several = (np.diff(np.append(starts, len(values))) > 1) | (flags >= 2)
    found = values[starts][several & ((flags & np.uint64(1)) == 1)]
    rows = []
    for chunk, mine in zip(bucket.column("chunk").to_pylist(), sent, strict=True):
        mine = mine // four
        if len(mine := mine[W.member(mine, found)]):
            rows.append((chunk, packed(mine)))
    return _batch(BACK, rows)


def _returned(group: pa.Table) -> np.ndarray:
    held = [unpacked(x) for x in group.column("held").to_pylist()]
    return np.sort(np.concatenate(held)) if held else np.zeros(0, dtype=np.uint64)


def _candidates(words: W.Words, found: np.ndarray, window: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the windows that cover a hit begin, with their hash and 16 bits of a second one."""
    hashes = words.hashes()
    none = np.zeros(0, dtype=np.uint64)
    at = W.windows(words.first, block)
    hit = at[W.member(_rolling(words, block, hashes=hashes) // np.uint64(4), found)]
    if not len(hit):
        return np.zeros(0, dtype=np.int64), none, none
    mark = np.zeros(len(words.starts) + 1, dtype=np.int64)
    mark[hit] = 1
    before = np.concatenate(([0], np.cumsum(mark)))
    at = W.windows(words.first, window)
    at = at[before[at + window - block + 1] > before[at]]
    first = W.range_hashes(W.prefix_sums(hashes, W.WORD_BASE), at, at + window, W.WORD_BASE)
    second = W.range_hashes(W.prefix_sums(hashes, W.WORD_BASE_2), at, at + window, W.WORD_BASE_2)
    return at, first, second >> np.uint64(48)


def extend(group: pa.Table, returned: pa.Table, window: int, block: int, n_buckets: int) -> pa.Table:
    """Step 3: distinct candidate windows; ``more`` marks those that occur here more than once."""
    found = _returned(returned)
    if not len(found) or not group.num_rows:
        return _batch("bucket int, chunk int, held binary, second binary, more binary", [])
    both = [_candidates(words, found, window, block)[1:] for _, words in _texts(group)]
    first, second = (np.concatenate([x[i] for x in both]) for i in (0, 1))
    order = np.lexsort((second, first))
    first, second = first[order], second[order].astype(np.uint16)
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(first)), dtype=bool), (first[1:] != first[:-1]) | (second[1:] != second[:-1]))))
    more = np.diff(np.append(new, len(first))) > 1
    first, second = first[new], second[new]
    chunk = group.column("chunk")[0].as_py()
    rows = [(k, chunk, packed(first[a:b]), second[a:b].tobytes(), np.packbits(more[a:b]).tobytes()) for k, a, b in by_bucket(first, n_buckets)]
    return _batch("bucket int, chunk int, held binary, second binary, more binary", rows)


def shared(bucket: pa.Table) -> pa.Table:
    """Step 4, first half: of each chunk's candidates a bit for each, whether the window occurs in two places."""
    first = [unpacked(x) for x in bucket.column("held").to_pylist()]
    second = [np.frombuffer(x, dtype=np.uint16) for x in bucket.column("second").to_pylist()]
    more = [np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=len(f)).astype(bool) for x, f in zip(bucket.column("more").to_pylist(), first, strict=True)]
    chunks = np.repeat(np.arange(len(first)), [len(x) for x in first])
    a, b, m = np.concatenate(first), np.concatenate(second), np.concatenate(more)
    order = np.lexsort((b, a))
    a, b, m, chunks = a[order], b[order], m[order], chunks[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    group = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    several = (np.diff(np.append(starts, len(a))) > 1) | np.logical_or.reduceat(m, starts)
    keep = several[group]
    a, b, chunks = a[keep], b[keep], chunks[keep]
    order = np.argsort(chunks, kind="stable")
    edges = np.searchsorted(chunks[order], np.arange(len(first) + 1))
    rows = []
    for i, chunk in enumerate(bucket.column("chunk").to_pylist()):
        mine = order[edges[i] : edges[i + 1]]
        if len(mine):
            rows.append((chunk, packed(a[mine]), b[mine].tobytes()))
    return _batch("chunk int, held binary, second binary", rows)


def cut(group: pa.Table, back: pa.Table, window: int, with_text: bool) -> pa.Table:
    """Step 4, second half: the words of each row that no shared window covers."""
    held = [unpacked(x) for x in back.column("held").to_pylist()]
    first_of = np.concatenate(held or [np.zeros(0, dtype=np.uint64)])
    second_of = np.concatenate([np.frombuffer(x, dtype=np.uint16) for x in back.column("second").to_pylist()] or [np.zeros(0, dtype=np.uint16)])
    key = np.sort(W.mix(first_of) ^ W.mix(second_of.astype(np.uint64) + np.uint64(1)))
    first_of = np.sort(first_of)
    n_words, n_removed, digests, kept_texts, spans = [], [], [], [], []
    for _, words in _texts(group):
        gone = np.zeros(len(words.starts), dtype=bool)
        if len(key):
            hashes, at = words.hashes(), W.windows(words.first, window)
            first = W.range_hashes(W.prefix_sums(hashes, W.WORD_BASE), at, at + window, W.WORD_BASE)
            near = W.member(first, first_of)
            at, first = at[near], first[near]
            second = W.range_hashes(W.prefix_sums(hashes, W.WORD_BASE_2), at, at + window, W.WORD_BASE_2) >> np.uint64(48)
            hit = W.member(W.mix(first) ^ W.mix(second + np.uint64(1)), key)
            gone = W.covered(at[hit], window, len(words.starts))
        total = np.concatenate(([0], np.cumsum(gone)))
        data = words.data.tobytes()
        removed = np.diff(total[words.first])
        for i, (lo, hi) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            own = data[words.offsets[i] : words.offsets[i + 1]]
            kept = own.split()
            runs = []
            if removed[i]:
                flags = gone[lo:hi]
                edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
                runs = edge.tolist()
                kept = [w for w, g in zip(kept, flags.tolist(), strict=True) if not g]
            joined = b" ".join(kept)
            n_words.append(hi - lo)
            n_removed.append(int(removed[i]))
            digests.append(hashlib.sha256(joined).hexdigest())
            spans.append(",".join(f"{s}:{e}" for s, e in zip(runs[::2], runs[1::2], strict=True)))
            kept_texts.append(joined.decode() if with_text else None)
    out = {"doc_id": group.column("doc_id").cast(pa.int64()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
    out |= {"kept_sha256": pa.array(digests, pa.string()), "repeats": pa.array(spans, pa.string())}
    if with_text:
        out["kept_text"] = pa.array(kept_texts, pa.string())
    return pa.table(out)


def dedup_substrings(docs: DataFrame, window: int = WINDOW, with_text: bool = True, chunk_bytes: int = CHUNK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: doc_id, n_words, n_removed, kept_sha256, repeats (word ranges cut, as start:end) and kept_text."""
    if window < 2:
        raise ValueError("a window has two words or more")
    block = (window + 1) // 2
    n, buckets = partitions_for(docs, chunk_bytes), partitions_for(docs, BUCKETS_EACH * chunk_bytes)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    dealt = slim.select(F.pmod(row_key(F.monotonically_increasing_id(), F.col("doc_id")), F.lit(n)).cast("int").alias("chunk"), "doc_id", "text")
    wide = "bucket int, chunk int, held binary, second binary, more binary"
    sent = dealt.groupBy("chunk").applyInArrow(lambda t: probes(t, block, buckets), SENT)
    found = sent.groupBy("bucket").applyInArrow(hits, BACK)
    asked = dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(lambda t, r: extend(t, r, window, block, buckets), wide)
    answered = asked.groupBy("bucket").applyInArrow(shared, "chunk int, held binary, second binary")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, repeats string" + (", kept_text string" if with_text else "")

    return dealt.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(lambda t, r: cut(t, r, window, with_text), schema)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT r, unnest(range(1, len(w) - 33)) AS p, unnest(list_transform(range(1, len(w) - 33), lambda p: md5(array_to_string(w[p : p + 34], ' ')))) AS h
  FROM d WHERE len(w) >= 35),
m AS (SELECT r, p FROM x WHERE h IN (SELECT h FROM x GROUP BY h HAVING count(*) > 1)),
g AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS i FROM m),
l AS (SELECT r, list(i) AS gone FROM g GROUP BY r),
k AS (SELECT doc_id, w, coalesce(gone, []::BIGINT[]) AS gone FROM d LEFT JOIN l USING (r))
SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(w, lambda v, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256 FROM k
"""
