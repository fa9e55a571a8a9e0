"""Quality rules with risk-controlled thresholds.

Each document gets counts (words, symbols, repeated lines, words in repeated 8-word windows, ...) and from them a few
measures of which junk has high values. Two rules are fixed: fewer than 20 words, or over 30 % of the words in repeated
windows. All other cutoffs are chosen on a labelled holdout:

* Strata are languages. For each stratum and measure there is a fixed ladder of cutoffs.
* A cutoff's false rejections are the labelled good documents at or above it that the fixed rules keep. With n such
  documents of the stratum of which k are rejected, the exact binomial test of "the rate exceeds the allowed risk"
  has the p-value P(Binomial(n, risk) <= k), so rejecting it at level d is a Clopper-Pearson upper bound below the risk.
* The risk of a stratum is divided by the number of measures, as a document goes if any measure rejects it; the error
  probability is divided by the number of ladders (strata x measures, Bonferroni). Rungs of a ladder are tested from the
  highest down and testing stops at the first that fails (fixed-sequence testing, which costs no further correction). So
  with probability ``1 - delta`` every stratum's rate is within its risk at once.
* The lowest cutoff that passed is taken. Strata without enough labels to prove any cutoff reject nothing by measures.

Counting needs no exchange of texts. Only histograms (stratum, measure, rung) are aggregated; labels join on ids.

Null texts count as empty (they fail the fixed rule); null languages are a stratum of their own, apart from empty ones. A
document that labels call good and bad counts as good only if all its labels do. Repeated rows are judged alike, and texts
that occur several times in a stratum are one trial. Texts of any length are counted whole; an empty table gives an empty
result. Extra columns are ignored by ``judge`` and kept by ``accepted``, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import words as W
from siftwell.llm.tables import fresh, row_key, table, text_or_empty
from siftwell.plans.staging import stage

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
RISK, DELTA = 0.02, 0.05
RUNGS = 40
#: Measures, with the ends of their ladders; rungs are even in the logarithm.
MEASURES = {"symbol_rate": (0.05, 2.0), "duplicate_line_rate": (0.05, 0.95), "repeat_rate": (0.03, 0.3), "upper_rate": (0.1, 0.95), "bar_rate": (0.05, 1.0)}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bars")

_FLAG = {name: np.zeros(256, dtype=np.int64) for name in ("symbol", "upper", "bar", "lead")}
_FLAG["symbol"][[ord(c) for c in "#*$%&|<>"]] = 1
_FLAG["upper"][65:91] = 1
_FLAG["bar"][ord("|")] = 1
_FLAG["lead"][:] = [(b & 0xC0) != 0x80 for b in range(256)]
_FLAG["lead"][W.SPACES] = 0


def counts(texts: pa.Array) -> np.ndarray:
    """A row of COUNTS for each text."""
    parts = [_counts(texts.slice(lo, hi - lo)) for lo, hi in W.slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(COUNTS)), dtype=np.int64)


def _counts(texts: pa.Array) -> np.ndarray:
    words = W.split(texts)
    data, offsets, first = words.data, words.offsets, words.first
    out = np.zeros((len(texts), len(COUNTS)), dtype=np.int64)
    out[:, 0] = np.diff(first)
    for column, flag in ((1, "lead"), (2, "symbol"), (6, "upper"), (7, "bar")):
        total = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(_FLAG[flag][data], out=total[1:])
        out[:, column] = np.diff(total[offsets])
    out[:, 3], out[:, 5] = _lines(words)
    hashes, at = words.hashes(), W.windows(first, WINDOW)
    doc = np.searchsorted(first, at, "right") - 1
    keyed = W.mix(W.range_hashes(W.prefix_sums(hashes, W.WORD_BASE), at, at + WINDOW, W.WORD_BASE) + doc.astype(np.uint64) * np.uint64(W.WORD_BASE_2))
    twice = W.repeated(keyed)
    if len(twice):
        inside = W.covered(at[W.member(keyed, twice)], WINDOW, len(words.starts))
        total = np.concatenate(([0], np.cumsum(inside)))
        out[:, 4] = np.diff(total[first])
    return out


def _lines(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """For each text: lines that have a word and equal an earlier line; lines that have a word."""
    data, offsets = words.data, words.offsets
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    ends = np.sort(np.concatenate((breaks, offsets[1:])), kind="stable")
    filled = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[filled], ends[filled]
    doc = np.searchsorted(offsets, starts, "right") - 1
    hashes = W.range_hashes(W.prefix_sums(W.BYTE_VALUES[data], W.BYTE_BASE), starts, ends, W.BYTE_BASE)
    order = np.lexsort((hashes, doc))
    again = np.zeros(len(order), dtype=np.int64)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    n = len(offsets) - 1
    return np.bincount(doc[order], weights=again, minlength=n).astype(np.int64), np.bincount(doc, minlength=n)


@W.frugal
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = counts(W.flat(batch.column("text")))
        rest = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
        names = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays(rest + [pa.array(found[:, k]) for k in range(len(COUNTS))], names=[*names, *COUNTS])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, row_key, text_key, stratum, the counts, base_failed and the measures of each row."""
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        row_key(F.col(id_col), F.col(text_col), F.col(stratum_col)).alias("row_key"),
        F.xxhash64(text_or_empty(text_col)).alias("text_key"),
        F.col(stratum_col).cast("string").alias("stratum"),
        text_or_empty(text_col).alias("text"),
    )
    schema = "doc_id long, row_key long, text_key long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS)
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return slim.mapInArrow(_counted, schema).withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
            "symbol_rate": F.col("n_symbols") / words,
            "duplicate_line_rate": F.col("n_dup_lines") / lines,
            "repeat_rate": F.col("n_repeat_words") / words,
            "upper_rate": F.col("n_upper") / F.greatest("word_chars", F.lit(1)),
            "bar_rate": F.col("n_bars") / words,
        }
    )


def ladder(name: str) -> list[float]:
    low, high = MEASURES[name]
    return [low * (high / low) ** (k / (RUNGS - 1)) for k in range(RUNGS)]


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), exactly summed in the logarithm."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    logs = np.concatenate(([0.0], np.cumsum(np.log(n - i[:-1]) - np.log(i[:-1] + 1)))) + i * math.log(p) + (n - i) * math.log1p(-p)
    top = logs.max()
    return min(1.0, math.exp(top) * float(np.exp(logs - top).sum()))


def cutoff(n: int, rejected: list[int], rungs: list[float], risk: float, level: float) -> float | None:
    """The lowest rung that is proven; ``rejected`` has the good documents at or above each rung."""
    best = None
    for k, rung in sorted(zip(rejected, rungs, strict=True), key=lambda x: -x[1]):
        if binomial_tail(k, n, risk) > level:
            break
        best = rung
    return best


def thresholds(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """stratum, and for each measure its cutoff (null: none is proven)."""
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")).where("quality = 1")
    held = measured.where(~F.col("base_failed")).join(good.select("doc_id"), "doc_id", "left_semi")
    above = [F.sum((F.col(m) >= rung).cast("long")).alias(f"{m}_{k}") for m in MEASURES for k, rung in enumerate(ladder(m))]
    # A text that occurs several times is one trial.
    once = held.groupBy("stratum", "text_key").agg(*[F.first(m).alias(m) for m in MEASURES])
    found = once.groupBy("stratum").agg(F.count("*").alias("n"), *above)
    table_ = stage(found, "holdout")
    tests = max(1, table_.count()) * len(MEASURES)

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = pd.DataFrame({"stratum": rows["stratum"]})
            for m in MEASURES:
                out[f"max_{m}"] = [cutoff(int(r.n), [int(r[f"{m}_{k}"]) for k in range(RUNGS)], ladder(m), risk / len(MEASURES), delta / tests) for _, r in rows.iterrows()]
            yield out.astype({f"max_{m}": "float64" for m in MEASURES})

    return stage(table_.mapInPandas(choose, "stratum string, " + ", ".join(f"max_{m} double" for m in MEASURES)), "thresholds")


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, **columns) -> DataFrame:
    """The counts of each row, base_failed, kept, and the measures that rejected it."""
    measured = stage(measure(docs, **columns), "measured")
    limits = thresholds(measured, labels, risk, delta)
    limits = limits.withColumnRenamed("stratum", "of_stratum")
    judged = measured.join(limits, F.col("stratum").eqNullSafe(F.col("of_stratum")), "left")
    bad = F.array_compact(F.array(*[F.when(F.col(m) >= F.col(f"max_{m}"), F.lit(m)) for m in MEASURES]))
    judged = judged.withColumn("rejected_by", F.array_join(bad, ","))
    return judged.select("doc_id", "row_key", "stratum", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("rejected_by") == "")).alias("kept"), "rejected_by")


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows that the rules keep, with the columns they had."""
    id_col, text_col, stratum_col = (options.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("stratum_col", "lang")))
    key = fresh(docs, "kept_key")
    kept = judge(docs, labels, **options).where("kept").select(F.col("row_key").alias(key)).distinct()
    return docs.withColumn(key, row_key(F.col(id_col), F.col(text_col), F.col(stratum_col))).join(kept, key, "left_semi").select(*docs.columns)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")
