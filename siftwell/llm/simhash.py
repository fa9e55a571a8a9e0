"""SimHash near-dedup: fingerprints linked by a binary trie self-join under a Hamming error budget.

Words are runs of anything but ASCII white space, after lower-casing A-Z; shingles are four words joined by a space,
repeats included (a text of fewer words is one shingle; a text of none has fingerprint zero and links like any other).
A fingerprint's bit is 1 if it is set in over half the shingles' XXH64 hashes (seed 42).

Distinct fingerprints, never rows, are joined: copies meet in the first aggregation, which keeps their smallest id. The
trie is spread over tasks by its first levels: the 64 bits are cut into ``budget + agree`` blocks, of which two linked
fingerprints share ``agree`` at least, so each fingerprint goes to one subtrie for each choice of ``agree`` blocks, in
which these bits are error-free levels. ``agree`` grows with the number of fingerprints so that subtries stay small.
Fingerprints of a subtrie that holds more than ``split_rows`` are routed again with a block more; where that does not part
them either, the subtrie is cut by a salt and joined part by part, pairs of parts being tasks of their own. In a task, node pairs are walked down together, level by level and many subtries at a time; differing
bits add up, a pair over the budget is pruned, and pairs of few leaves are settled by counting bits. A task returns a
spanning forest of what it linked, not its pairs; components over the forests give the groups.

Null texts count as empty; null ids take part, and a component's id is its smallest id that is not null. Repeated rows
give repeated result rows. Texts of any length are read whole, each in one task; an empty table gives an empty result.
Extra columns are ignored by ``near_duplicates`` and ``near_copies`` and kept by ``keep_one``, whatever their names, which
takes five words and a verified similarity of 0.8.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.llm import words as W
from siftwell.llm.resemblance import similar_pairs, sketched
from siftwell.llm.tables import fresh, row_key, table, text_or_empty
from siftwell.operators.graph import connected_components
from siftwell.plans.staging import scratch, stage

SHINGLE_WORDS = 4
STAGE_SHINGLE_WORDS, SIMILARITY = 5, 0.8
BUDGET = 4
SEED = 42
SPLIT_ROWS = 8192
SUBTRIE_ROWS = 64
#: Agreeing blocks up to which crowded subtries are routed again.
MOST_AGREE = 6
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LEAF_PAIRS = 16
_FRONTIER = 1 << 20


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)]
    lanes = np.array(hashes, dtype=np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


@W.frugal
def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    root = parent[at]
    while True:
        above = parent[root]
        if np.array_equal(above, root):
            return root
        root = above


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        a, b = _roots(parent, a), _roots(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def trie_links(group: np.ndarray, fp: np.ndarray, part: np.ndarray, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as pairs of fingerprints, of the links inside each group.

    ``part`` is 0 or 1 for each row: in a group that has both, only pairs across the parts are walked.
    """
    order = np.lexsort((fp, part, group))
    group, fp, part = group[order], fp[order], part[order]
    n = len(fp)
    new = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (part[1:] != part[:-1])))) if n else np.zeros(0, dtype=np.int64)
    ends = np.append(new[1:], n)
    lone = np.ones(len(new), dtype=bool)
    twin = np.flatnonzero(group[new][1:] == group[new][:-1])
    lone[twin] = lone[twin + 1] = False
    parent = np.arange(n)
    a = np.concatenate((new[lone], new[twin]))
    b = np.concatenate((new[lone], new[twin + 1]))
    ae = np.concatenate((ends[lone], ends[twin]))
    be = np.concatenate((ends[lone], ends[twin + 1]))
    work = [(63, a, ae, b, be, np.zeros(len(a), dtype=np.int8))]
    while work:
        bit, a, ae, b, be, err = work.pop()
        if len(a) > _FRONTIER:
            cuts = np.arange(0, len(a), _FRONTIER)
            work += [(bit, a[i : i + _FRONTIER], ae[i : i + _FRONTIER], b[i : i + _FRONTIER], be[i : i + _FRONTIER], err[i : i + _FRONTIER]) for i in cuts]
            continue
        few = ((ae - a) * (be - b) <= _LEAF_PAIRS) | (bit < 0)
        _settle(fp, parent, a[few], ae[few], b[few], be[few], budget)
        a, ae, b, be, err = a[~few], ae[~few], b[~few], be[~few], err[~few]
        if not len(a):
            continue
        am, bm = _middle(fp, a, ae, bit), _middle(fp, b, be, bit)
        same = a == b
        next_ = [(a, am, b, bm, err), (am, ae, bm, be, err), (a, am, bm, be, err + 1), (am[~same], ae[~same], b[~same], bm[~same], err[~same] + 1)]
        a, ae, b, be, err = (np.concatenate([x[i] for x in next_]) for i in range(5))
        live = (a < ae) & (b < be) & (err <= budget)
        work.append((bit - 1, a[live], ae[live], b[live], be[live], err[live]))
    root = _roots(parent, np.arange(n))
    linked = np.flatnonzero(root != np.arange(n))
    return fp[linked], fp[root[linked]]


def _middle(fp: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where the rows of [lo, hi), which agree above ``bit``, begin to have it."""
    lo, hi, shift = lo.copy(), hi.copy(), np.uint64(bit)
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        has = ((fp[np.minimum(mid, len(fp) - 1)] >> shift) & np.uint64(1)) == 1
        hi = np.where(open_ & has, mid, hi)
        lo = np.where(open_ & ~has, mid + 1, lo)


def _settle(fp: np.ndarray, parent: np.ndarray, a: np.ndarray, ae: np.ndarray, b: np.ndarray, be: np.ndarray, budget: int) -> None:
    """Links among the leaves of each node pair, by counting differing bits."""
    width = be - b
    sizes = (ae - a) * width
    pair = np.repeat(np.arange(len(a)), sizes)
    inner = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x, y = a[pair] + inner // width[pair], b[pair] + inner % width[pair]
    near = (x != y) & (np.bitwise_count(fp[x] ^ fp[y]) <= budget)
    _unite(parent, x[near], y[near])


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (subtrie, fp, part) sorted by subtrie; whole subtries are joined many at a time."""
    held: list[list[np.ndarray]] = []

    def links(rows: list[np.ndarray]) -> pa.RecordBatch:
        a, b = trie_links(rows[0], rows[1].view(np.uint64), rows[2])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["src", "dst"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        last = int(np.searchsorted(rows[0], rows[0][-1]))
        if last or (held and held[-1][0][0] != rows[0][-1]):
            done = [*held, [r[:last] for r in rows]]
            yield links([np.concatenate([d[i] for d in done]) for i in range(3)])
            held = []
        held.append([r[last:] for r in rows])
    if held:
        yield links([np.concatenate([d[i] for d in held]) for i in range(3)])


def agreeing_blocks(n: int, budget: int = BUDGET, rows: int = SUBTRIE_ROWS) -> int:
    """The fewest agreeing blocks that leave subtries of even fingerprints with about ``rows`` rows."""
    for agree in range(1, 5):
        if n / 2 ** math.floor(64 * agree / (budget + agree)) <= rows:
            return agree
    return 4


def _routes(fp: Column, agree: int, budget: int) -> Column:
    """The subtries of a fingerprint: a hash of each choice of blocks and their bits."""
    blocks = budget + agree
    edges = [64 * i // blocks for i in range(blocks + 1)]
    value = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")) for a, b in zip(edges, edges[1:], strict=False)]
    return F.array(*[F.xxhash64(F.lit(k), *[value[i] for i in chosen]) for k, chosen in enumerate(combinations(range(blocks), agree))])


def links(fps: DataFrame, n: int, budget: int = BUDGET, split_rows: int = SPLIT_ROWS, agree: int | None = None, most_agree: int = MOST_AGREE) -> DataFrame:
    """(src, dst): a forest that connects all of the distinct ``fp`` that links of at most ``budget`` bits connect.

    Two linked fingerprints share a subtrie for any number of agreeing blocks, so the fingerprints of subtries that hold
    more than ``split_rows`` are routed again with one block more, up to ``most_agree``; only then are subtries cut by a salt.
    """
    agree = agree or agreeing_blocks(n, budget)
    routed = fps.select(F.explode(_routes(F.col("fp"), agree, budget)).alias("at"), "fp")
    large = stage(routed.groupBy("at").count().where(F.col("count") > split_rows).select("at", F.ceil(F.col("count") / split_rows).cast("int").alias("parts")), "subtries")
    if large.isEmpty():
        return _walked(routed.withColumn("part", F.lit(0)))
    if agree < most_agree:
        crowded = stage(routed.join(large.select("at"), "at", "left_semi").select("fp").distinct(), "crowded")
        small = routed.join(large.select("at"), "at", "left_anti").withColumn("part", F.lit(0))
        return _walked(small).unionByName(links(crowded, n, budget, split_rows, agree + 1, most_agree))
    salt = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
    marked = routed.join(large, "at", "left").withColumn("salt", F.coalesce(salt, F.lit(0)))
    other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))).alias("other")
    pairs = marked.select("at", "fp", "salt", other)
    return _walked(pairs.select(F.xxhash64("at", F.least("salt", "other"), F.greatest("salt", "other")).alias("at"), "fp", (F.col("salt") > F.col("other")).cast("int").alias("part")))


def _walked(routed: DataFrame) -> DataFrame:
    return routed.repartition(F.col("at")).sortWithinPartitions("at").mapInArrow(_join, "src long, dst long")


def near_duplicates(docs: DataFrame, budget: int = BUDGET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = stage(slim.mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    forest = links(distinct.select("fp"), distinct.count(), budget)
    labels = connected_components(forest).withColumnRenamed("node", "fp")
    members = distinct.join(labels, "fp")
    least = stage(members.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    linked = stage(labels.join(least, "component").select("fp", "component_id"), "linked")
    named = stage(distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")), "components")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_copies(docs: DataFrame, similarity: float = SIMILARITY, shingle_words: int = STAGE_SHINGLE_WORDS, budget: int = BUDGET, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row for each row: doc_id, row_key (a hash of id and text), component_id, keeper (the row_key that stays).

    Groups are of texts whose shingle sets are at least so similar. Candidates are the fingerprints' links by the trie
    self-join and, as these find few pairs of a similarity under 0.95, the prefix join of ``resemblance``; all are verified
    on whole sets. Texts with one set of shingles are one before they are compared. Here a fingerprint is over the window
    hashes that the sets have. A component's id is its smallest id that is not null, its keeper the smallest row key
    of that id, or of all its rows if none has an id.
    """
    with scratch():
        slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), row_key(F.col(id_col), text_or_empty(text_col)).alias("row_key"))
        rows = sketched(slim, shingle_words)
        own = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
        sets = stage(rows.where("kind = 0").groupBy("set").agg(own.alias("least"), F.min("fp").alias("fp")), "sets")
        prints = stage(sets.groupBy("fp").agg(F.min("set").alias("of")), "prints")
        forest = links(prints.select("fp"), prints.count(), budget)
        ends = [prints.select(F.col("fp").alias(side), F.col("of").alias(f"{side}_set")) for side in ("src", "dst")]
        across = forest.join(ends[0], "src").join(ends[1], "dst").select(F.col("src_set").alias("src"), F.col("dst_set").alias("dst"))
        within = sets.join(prints, "fp").where(F.col("set") != F.col("of")).select(F.col("of").alias("src"), F.col("set").alias("dst"))
        pairs = similar_pairs(slim, rows, stage(across.unionByName(within), "candidates"), similarity, shingle_words, **options)
        labels = connected_components(pairs).withColumnRenamed("node", "set")
        labelled = stage(sets.join(labels, "set", "left").select("set", "least", F.coalesce("component", "set").alias("component")), "labelled")
        best = labelled.groupBy("component").agg(F.min("least").alias("best"))
        named = stage(labelled.join(best, "component").select("set", F.col("best.doc_id").alias("component_id"), F.col("best.row_key").alias("keeper")), "groups")
        return stage(rows.where("kind = 0").select("doc_id", "row_key", "set").join(named, "set").select("doc_id", "row_key", "component_id", "keeper"), "near_copies", keep=True)


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near copies, the one with its smallest id, with the columns it had.

    Rows without an id stay only if their group has no id at all. Rows that repeat both id and text are told apart by
    their other columns, of which the smallest hash stays; different texts under one id are rows of their own.
    """
    columns = [options.get(k, k.replace("id_col", "doc_id").replace("text_col", "text")) for k in ("id_col", "text_col")]
    key, place = fresh(docs, "kept_key"), fresh(docs, "kept_place")
    copies = near_copies(docs, **options)
    kept = copies.where("row_key = keeper").groupBy(F.col("keeper").alias(key)).agg(F.count("*").alias(place))
    keyed = docs.withColumn(key, row_key(F.col(columns[0]), text_or_empty(columns[1])))
    single = keyed.join(kept.where(F.col(place) == 1), key, "left_semi").select(*docs.columns)
    several = stage(kept.where(F.col(place) > 1).select(key), "repeated_rows")
    if several.isEmpty():
        return single
    order = Window.partitionBy(key).orderBy(F.xxhash64(*[F.to_json(F.struct(c)) for c in docs.columns]))
    once = keyed.join(several, key, "left_semi").withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return single.unionByName(once.select(*docs.columns))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
