"""Resemblance of texts (Jaccard similarity of their word shingles): an exact prefix join and verification on whole sets.

A fingerprint of 64 bits with a budget of 4 finds next to no pair of similarity 0.8 to 0.9, whose fingerprints differ in
8 to 10 bits, so near-duplicate groups take candidates from here as well. No candidate is left to chance:

* All distinct shingles have one order over the whole corpus: those of one text alone first, the others by how many texts
  have them, the rarest first. Two sets of similarity t or more share a shingle among the first ``n - ceil(t * n) + 1`` of
  each (the prefix), so only prefixes meet. Boilerplate comes last and is in hardly any prefix; a text with more than
  ``1 - t`` of its shingles to itself has nothing to meet and sends nothing.
* At the first shingle that a pair shares, positions i and j bound its overlap by ``min(n - i, m - j)``; pairs that
  cannot reach the overlap that t needs are dropped in the join.
* Pairs that are left are verified on the whole sets (32 bits a shingle), whatever their size.

Counting the texts of each shingle is one exchange: tasks send sorted, compressed runs of (shingle, set) to buckets by
range of hashes, and a bucket holds a bounded share of them. Shingles that a millionth of all such rows or more have
(``HOT_SHARE``; at most two million, a bound that does not depend on the input) are sent to executors beforehand and come
last in the order; their rows are not exchanged but for the texts that have too few others.

Each shingle's texts are compared with leaders first: the text of the bucket that has least to itself, then one at random,
then all with one another, but never two texts that are of one component already. So in a group of k similar
texts about k pairs are made. What is left is exact: pairs of texts of different components that share a rare shingle
and could be similar by their sizes and positions.

Texts without words are one set. Texts with fewer words than a shingle have one shingle. Sets, not rows, are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.llm import words as W
from siftwell.llm.substring_dedup import by_bucket, packed, unpacked
from siftwell.operators.graph import connected_components
from siftwell.plans.staging import partitions_for, stage

#: Share of all (shingle, set) rows from which on a shingle is sent beforehand, and the least number of its rows.
HOT_SHARE, HOT_LEAST = 1e-6, 1 << 16
#: Input bytes to each bucket of shingles, and shingles in a run that a task sends to them.
BUCKET_BYTES, RUN_TOKENS = 8 << 20, 1 << 20
#: Texts of a bucket that one block of a comparison has from each side.
BLOCK_ROWS = 256
MESSAGE = "bucket int, kind int, first binary, sets binary, places binary"
_RUN, _FACTS = 0, 1
SKETCHED = "kind int, doc_id long, row_key long, fp long, set long, n long, whole binary"
_TOKEN, _HOT, _SIZE, _HOT_SIZE = 0, 1, 2, 3


class Shingled:
    """The shingle hashes of some texts (A-Z lower-cased): all in turn, and each text's distinct ones, cut to 48 bits and sorted."""

    def __init__(self, texts: pa.Array, size: int) -> None:
        words = W.split(texts, lower=True)
        sums = W.prefix_sums(words.hashes(), W.WORD_BASE)
        lengths = np.diff(words.first)
        width = np.minimum(lengths, size)
        counts = np.where(lengths > 0, lengths - width + 1, 0)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        at = np.arange(self.first[-1]) + np.repeat(words.first[:-1] - self.first[:-1], counts)
        self.shingles = W.range_hashes(sums, at, at + np.repeat(width, counts), W.WORD_BASE)
        edges, short = self.first.tolist(), self.shingles >> np.uint64(16)
        self.distinct = [np.unique(short[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
        self.sizes = np.array([len(x) for x in self.distinct], dtype=np.int64)
        totals = [(int(x.sum(dtype=np.uint64)) + len(x) * W.WORD_BASE_2) % (1 << 64) for x in self.distinct]
        self.sets = W.mix(np.array(totals, dtype=np.uint64))

    def fingerprints(self) -> np.ndarray:
        """A bit is 1 if it is set in over half of a text's shingles, repeats included; no shingles give zero."""
        out = np.zeros((len(self.sizes), 64), dtype=bool)
        filled = np.flatnonzero(self.sizes)
        if len(filled):
            bits = np.unpackbits(self.shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, self.first[:-1][filled], axis=0, dtype=np.int64)
            out[filled] = 2 * ones > np.diff(self.first)[filled][:, None]
        return np.packbits(out, axis=1, bitorder="little").view(np.uint64).ravel()

    def once(self) -> np.ndarray:
        """Positions of the texts whose set no earlier text of these has."""
        return np.unique(self.sets, return_index=True)[1]


def shingled(texts: pa.Array, size: int) -> Iterator[tuple[int, int, Shingled]]:
    for lo, hi in W.slices(texts):
        yield lo, hi, Shingled(texts.slice(lo, hi - lo), size)


def sketched(texts: DataFrame, size: int, hot_share: float = HOT_SHARE) -> DataFrame:
    """Of each row of (doc_id, row_key, text), kind 0: its fingerprint, set, number of shingles, and whole set.

    Rows of kind 1 have a shingle as set and in n how many texts nearby have it, where this may make it a hot one.
    """

    @W.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary()]
        names = [x.split()[0] for x in SKETCHED.split(", ")]
        for batch in batches:
            for lo, hi, own in shingled(W.flat(batch.column(2)), size):
                n = hi - lo
                whole = pa.array([(x >> np.uint64(16)).astype(np.uint32).tobytes() for x in own.distinct], pa.binary())
                columns = [pa.array(np.zeros(n, dtype=np.int32)), batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array(own.fingerprints().view(np.int64)), pa.array(own.sets.view(np.int64)), pa.array(own.sizes), whole]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                every = np.sort(np.concatenate([own.distinct[i] for i in own.once()]))
                starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(every)), dtype=bool), every[1:] != every[:-1])))
                counts = np.diff(np.append(starts, len(every)))
                near = counts >= max(3, hot_share / 2 * len(every))
                none = pa.nulls(int(near.sum()), pa.int64())
                some = [pa.array(np.ones(len(none), dtype=np.int32)), none, none, none, pa.array(every[starts[near]].view(np.int64)), pa.array(counts[near]), pa.nulls(len(none), pa.binary())]
                yield pa.RecordBatch.from_arrays(some, names=names)

    return stage(texts.select("doc_id", "row_key", "text").mapInArrow(run, SKETCHED), "sketched")


def hot_shingles(rows: DataFrame, hot_share: float = HOT_SHARE, hot_least: int = HOT_LEAST) -> np.ndarray:
    """Shingles of at least half of ``hot_share`` of all rows; every one of ``hot_share`` or more is among them.

    A shingle of a share s of all rows has a share of s / 2 at least in slices that hold half of its rows, so the rows of
    kind 1 miss none. There are at most ``2 / hot_share`` of them.
    """
    total = rows.where("kind = 0").agg(F.sum("n")).first()[0] or 0
    least = max(hot_least, hot_share / 2 * total)
    found = rows.where("kind = 1").groupBy("set").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("set").collect()
    return np.sort(np.array([r[0] for r in found], dtype=np.int64).view(np.uint64))


def _least_overlap(n: np.ndarray | int, similarity: float) -> np.ndarray:
    return np.ceil(np.round(np.asarray(n) * similarity, 9)).astype(np.int64)


class _Outbox:
    """Messages of a task: shingles by range of their hashes, in runs that hold several slices; and what is known of sets."""

    def __init__(self, n_buckets: int) -> None:
        self.n_buckets, self.rows, self.held = n_buckets, [], 0
        self.tokens: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []

    def facts(self, more: np.ndarray, sets: np.ndarray) -> None:
        if len(sets):
            self.rows.append((int(sets[0]) % self.n_buckets, _FACTS, more.tobytes(), sets.tobytes(), None))

    def add(self, tokens: np.ndarray, owners: np.ndarray) -> None:
        self.tokens.append(tokens)
        self.owners.append(owners)
        self.held += len(tokens)

    def close_run(self) -> None:
        if self.held:
            tokens, owners = np.concatenate(self.tokens), np.concatenate(self.owners)
            self.tokens, self.owners = [], []
            order = np.argsort(tokens, kind="stable")
            tokens, owners = tokens[order], owners[order]
            del order
            for bucket, lo, hi in by_bucket(tokens << np.uint64(16), self.n_buckets):
                sets, places = np.unique(owners[lo:hi], return_inverse=True)
                places = places.astype(np.uint16 if len(sets) <= 1 << 16 else np.uint32)
                self.rows.append((bucket, _RUN, packed(tokens[lo:hi]), sets.tobytes(), zstandard.compress(places.tobytes(), 1)))
        self.tokens, self.owners, self.held = [], [], 0

    def take(self) -> pa.RecordBatch:
        columns, self.rows = list(zip(*self.rows, strict=True)) or [()] * 5, []
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in MESSAGE.split(", ")])


def _messages(texts: DataFrame, size: int, similarity: float, hot: np.ndarray, n_buckets: int) -> DataFrame:
    """Runs of (shingle, set) by bucket, hot shingles left out; and facts, as pairs of a number and a set.

    A fact carries its kind in the two lowest bits and a value above: the set's size, the number of its hot shingles, or
    a hot shingle that the prefix needs, by its place in ``hot``.
    """
    sent = texts.sparkSession.sparkContext.broadcast(hot)
    four = np.uint64(4)

    @W.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Outbox(n_buckets)
        for batch in batches:
            for _, _, own in shingled(W.flat(batch.column(0)), size):
                once = own.once()
                once = once[own.sizes[once] > 0]
                if not len(once):
                    continue
                sets, sizes = own.sets[once], own.sizes[once]
                tokens, of = np.concatenate([own.distinct[i] for i in once]), np.repeat(np.arange(len(once)), sizes)
                out.facts(sizes.astype(np.uint64) * four + _SIZE, sets)
                is_hot = W.member(tokens, sent.value)
                if is_hot.any():
                    n_hot = np.bincount(of[is_hot], minlength=len(once))
                    before = np.cumsum(is_hot) - is_hot
                    before -= np.repeat(before[np.cumsum(sizes) - sizes], sizes)
                    room = sizes - _least_overlap(sizes, similarity) + 1 - (sizes - n_hot)
                    wanted, some = is_hot & (before < room[of]), n_hot > 0
                    out.facts(n_hot[some].astype(np.uint64) * four + _HOT_SIZE, sets[some])
                    out.facts(np.searchsorted(sent.value, tokens[wanted]).astype(np.uint64) * four + _HOT, sets[of[wanted]])
                    tokens, of = tokens[~is_hot], of[~is_hot]
                out.add(tokens, sets[of])
                if out.held >= RUN_TOKENS:
                    del tokens, of
                    out.close_run()
                    yield out.take()
                    W.release()
        out.close_run()
        yield out.take()

    return texts.select("text").mapInArrow(run, MESSAGE)


@W.frugal
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """token, more, set, n_sets of the messages of each bucket, which follow one another; shingles of one set go."""

    def made(token: np.ndarray, more: np.ndarray, sets: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(sets), 1 << 18):
            part = [pa.array(x[lo : lo + (1 << 18)].view(np.int64)) for x in (token, more, sets, n)]
            yield pa.RecordBatch.from_arrays(part, names=["token", "more", "set", "n_sets"])

    def closed(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        tokens, sets = np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs])
        runs.clear()
        several = W.member(tokens, W.repeated(tokens))
        tokens, sets = tokens[several], sets[several]
        order = np.lexsort((sets, tokens))
        tokens, sets = tokens[order], sets[order]
        fresh = np.ones(len(tokens), dtype=bool)
        fresh[1:] = (tokens[1:] != tokens[:-1]) | (sets[1:] != sets[:-1])
        tokens, sets = tokens[fresh], sets[fresh]
        starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(tokens)), dtype=bool), tokens[1:] != tokens[:-1])))
        widths = np.diff(np.append(starts, len(tokens)))
        n = np.repeat(widths, widths)
        keep = n > 1
        return made(tokens[keep], np.zeros(int(keep.sum()), dtype=np.uint64), sets[keep], n[keep])

    bucket, runs = None, []
    for batch in batches:
        for row in range(batch.num_rows):
            at, kind, first, sets, places = (batch.column(i)[row] for i in range(5))
            at, owners = at.as_py(), np.frombuffer(sets.as_buffer(), dtype=np.uint64)
            if kind.as_py() == _FACTS:
                none = np.zeros(len(owners), dtype=np.uint64)
                yield from made(none, np.frombuffer(first.as_buffer(), dtype=np.uint64), owners, none)
                continue
            if at != bucket and runs:
                yield from closed(runs)
            bucket = at
            raw = zstandard.decompress(places.as_buffer())
            runs.append((unpacked(first.as_buffer()), owners[np.frombuffer(raw, dtype=np.uint16 if len(owners) <= 1 << 16 else np.uint32)]))
    if runs:
        yield from closed(runs)


def prefixes(texts: DataFrame, size: int, similarity: float, hot: np.ndarray) -> DataFrame:
    """token, set, n, alone (shingles that no other set has), pos of each set's prefix; shingles of one set are left out."""
    n_buckets = partitions_for(texts, BUCKET_BYTES)
    dealt = _messages(texts, size, similarity, hot, n_buckets).repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
    counted = dealt.mapInArrow(_counted, "token long, more long, set long, n_sets long")
    kind, value = F.col("more").bitwiseAND(F.lit(3)), F.shiftright("more", 2)
    last = (kind == _HOT).cast("int") + 2 * (kind > _HOT).cast("int")
    whole = Window.partitionBy("set")
    # Facts of a set may come more than once, from tasks that each had a copy of it.
    sized = counted.withColumn("rank", F.dense_rank().over(whole.orderBy(last, "n_sets", "more", "token"))).withColumns(
        {
            "n": F.max(F.when(kind == _SIZE, value)).over(whole),
            "n_hot": F.coalesce(F.max(F.when(kind == _HOT_SIZE, value)).over(whole), F.lit(0)),
            "met": F.count_if(kind == _TOKEN).over(whole),
        }
    )
    sized = sized.withColumn("alone", F.col("n") - F.col("n_hot") - F.col("met")).withColumn("pos", F.col("alone") + F.col("rank") - 1)
    prefix = F.col("n") - F.ceil(F.round(F.col("n") * similarity, 9)) + 1
    # Hot shingles are named by numbers below those of others.
    token = F.when(kind == _TOKEN, F.col("token")).otherwise(-1 - value)
    return sized.where((kind <= _HOT) & (F.col("pos") < prefix)).select(token.alias("token"), "set", "n", "alone", "pos")


def resemblance(a: bytes, b: bytes) -> float:
    """Similarity of two whole sets of 32-bit hashes, each sorted and distinct; two empty sets are alike."""
    x, y = np.frombuffer(a, dtype=np.uint32), np.frombuffer(b, dtype=np.uint32)
    both = np.concatenate((x, y))
    both.sort()
    if not len(both):
        return 1.0
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (len(both) - shared)


def verified(pairs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """(src, dst): those of the distinct pairs whose whole sets are similar enough; ``held`` has (set, whole) once each."""

    @W.frugal
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = [resemblance(x.as_buffer(), y.as_buffer()) >= similarity for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select(["src", "dst"]).filter(pa.array(like, pa.bool_()))

    one = held.select(F.col("set").alias("src"), F.col("whole").alias("of_src"))
    two = held.select(F.col("set").alias("dst"), F.col("whole").alias("of_dst"))
    joined = pairs.join(two, "dst").join(one, "src").select("src", "dst", "of_src", "of_dst")
    return stage(joined.mapInArrow(check, "src long, dst long"), "alike")


def _could(similarity: float, a: str, b: str) -> Column:
    """Whether sizes and positions let rows ``a`` and ``b`` (prefixes of n and pos) be similar."""
    n, m, i, j = (F.col(x) for x in (f"{a}n", f"{b}n", f"{a}pos", f"{b}pos"))
    needed = F.ceil(F.round((n + m) * similarity / (1 + similarity), 9))
    return (F.least(n - i, m - j) >= needed) & (F.least(n, m) >= F.round(F.greatest(n, m) * similarity, 9))


def _named(buckets: DataFrame, found: DataFrame, label: str) -> DataFrame:
    """Bucket rows with the component of their set so far and ``main``, that of the bucket's leader; of buckets that hold several components."""
    labels = connected_components(found).select(F.col("node").alias("set"), "component")
    named = stage(buckets.join(labels, "set", "left").withColumn("component", F.coalesce("component", "set")), label)
    main = F.min(F.struct("alone", "set", "component"))["component"].alias("main")
    mixed = named.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), main).where("lo <> hi").select("token", "main")
    return stage(named.join(stage(mixed, "mixed"), "token"), label)


def similar_pairs(texts: DataFrame, rows: DataFrame, more: DataFrame, similarity: float, size: int, hot_share: float = HOT_SHARE, hot_least: int = HOT_LEAST) -> DataFrame:
    """(src, dst): pairs of similar sets that connect all sets that similar pairs connect; ``more`` are candidates too.

    ``rows`` is what ``sketched`` made of the ``texts``.
    """
    hot = hot_shingles(rows, hot_share, hot_least)
    buckets = stage(prefixes(texts, size, similarity, hot), "prefixes")
    lead = F.min(F.struct("alone", "set", "n", "pos"))
    leads = buckets.groupBy("token").agg(F.count("*").alias("held"), lead.alias("lead")).where("held > 1").select("token", *(F.col(f"lead.{x}").alias(f"l{x}") for x in ("set", "n", "pos")))
    near = stage(buckets.join(stage(leads, "leads"), "token"), "led")
    first = near.where(F.col("set") != F.col("lset")).where(_could(similarity, "", "l")).select(F.col("lset").alias("src"), F.col("set").alias("dst"))
    pairs = stage(first.unionByName(more.where("src <> dst")).distinct(), "asked")
    buckets = near.select("token", "set", "n", "alone", "pos")
    wanted = buckets.select("set").unionByName(more.select(F.col("src").alias("set"))).unionByName(more.select(F.col("dst").alias("set"))).distinct()
    held = rows.where("kind = 0").select("set", "whole").join(wanted, "set", "left_semi").groupBy("set").agg(F.first("whole").alias("whole"))
    held = stage(held, "wholes")
    found = verified(pairs, held, similarity)
    named = _named(buckets, found, "named")
    if named.isEmpty():
        return found
    drawn = F.min(F.struct(F.xxhash64("token", "set").alias("draw"), "set", "n", "pos", "component"))
    leads = named.groupBy("token").agg(drawn.alias("lead")).select("token", *(F.col(f"lead.{x}").alias(f"l{x}") for x in ("set", "n", "pos", "component")))
    met = named.join(stage(leads, "leads"), "token").where(F.col("component") != F.col("lcomponent")).where(_could(similarity, "", "l"))
    asked = met.select(F.least("set", "lset").alias("src"), F.greatest("set", "lset").alias("dst")).distinct()
    found = stage(found.unionByName(verified(stage(asked, "asked"), held, similarity)), "found")
    named = _named(buckets, found, "left_out")
    if named.isEmpty():
        return found
    return found.unionByName(verified(_left_out(named, similarity), held, similarity))


def _left_out(named: DataFrame, similarity: float) -> DataFrame:
    """(src, dst): distinct pairs of a bucket's texts whose components differ.

    One of two such texts is outside the main component, so only these are compared with all, in blocks of their own.
    """
    others = named.where("component <> main")
    blocks = stage(others.groupBy("token").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")), "blocks")
    columns = lambda x: [F.col(c).alias(f"{x}{c}") for c in ("set", "n", "pos", "component")]
    block = F.pmod(F.xxhash64("set", F.lit(11)), F.col("blocks")).alias("block")
    a = others.join(blocks, "token").select("token", block, *columns("a"))
    b = named.join(blocks, "token").select("token", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"), *columns("b"))
    met = stage(a, "outside").join(stage(b, "all"), ["token", "block"]).where((F.col("acomponent") != F.col("bcomponent")) & _could(similarity, "a", "b"))
    return stage(met.select(F.least("aset", "bset").alias("src"), F.greatest("aset", "bset").alias("dst")).distinct(), "left_out")
