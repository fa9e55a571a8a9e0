"""Secret scans with corpus-wide ownership frequency, in DataFrame operations only.

Base kinds: ``assign`` (a password-like name, then : or =, then a value of 8 characters or more), ``access`` (AKIA and
capitals or digits, 16 characters or more) and ``hex`` (32 lower-case hexadecimal digits or more). Matches are leftmost
and do not overlap within a kind; a match that is too short is dropped after it was made. A fourth kind, ``opaque``, has
whole runs of 20 characters or more of ``[A-Za-z0-9_-]`` with a digit, a capital and a small letter.

Positions come from splitting the text at the matches: lengths of pieces and matches alternate, so running sums over a
row's exploded matches are starts, counted in code points. Values are hashed; the corpus-wide frequency of a hash is its
number of distinct repositories and of distinct owners. A value in few of both is live-looking; one that many share is an
example that is widely copied. Base spans are reported whatever their frequency; opaque spans are added only if
live-looking.

Texts are scanned once, and only their matches are staged (by ``mask`` the rows too, so that it reads no text twice).
Frequencies are aggregated by (hash, repository, owner) first, so an example that a third of all rows contain is a few
rows before it meets in one place. Hashes of a hundred-thousandth of all occurrences or more, of which there are at most
so many, are sent to executors for the join back; the others are joined by hash.

A text may have any length and any number of matches: no step is worse than linear in them, as masks are laid over blocks
of 4,096 code points. Null texts count as empty (``mask`` leaves them null); null repositories or owners are one of their
own; an empty table gives an empty result. Repeated rows give repeated result rows and do not raise a frequency. Other
columns are ignored by ``scan`` and kept by ``mask``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.llm.tables import fresh, table, text_or_empty
from siftwell.plans.staging import stage

#: Kinds in their order, with the pattern, the group that is the secret, and its least length.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
    ("opaque", r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]*[0-9])(?=[A-Za-z0-9_-]*[A-Z])(?=[A-Za-z0-9_-]*[a-z])[A-Za-z0-9_-]{20,}(?![A-Za-z0-9_-])", 0, 20),
)
#: What must match somewhere for a kind to have a span; spares the others the exact scan.
_QUICK = {"access": "AKIA[A-Z0-9]{12}", "hex": "[0-9a-f]{32}"}
#: A hex run is cut to those of full length at once: runs are maximal, so dropping short ones changes no other.
_EXACT = {"hex": "[0-9a-f]{32,}", "access": "AKIA[A-Z0-9]{12,}"}
MAX_REPOSITORIES, MAX_OWNERS = 2, 1
#: Hashes with this share of all occurrences, and so many at least, are joined by sending them.
HOT_SHARE, HOT_LEAST = 1e-5, 1 << 16
BLOCK = 4096
_MATCH = "array<struct<kind:int,pos:int,before:int,width:int,secret:int,hash:string>>"
_SEEN = "array<struct<start:bigint,kind:int,end:bigint,live:boolean>>"


def _matches(text: Column, k: int) -> Column:
    """The matches of kind k, in order: lengths of the piece before, of the match and of its secret, and the secret's hash."""
    name, pattern, group, _ = KINDS[k]
    exact = _EXACT.get(name, pattern)
    found = F.regexp_extract_all(text, F.lit(exact), F.lit(0))
    both = F.arrays_zip(F.slice(F.split(text, exact, -1), 1, F.size(found)).alias("p"), found.alias("m"), F.regexp_extract_all(text, F.lit(exact), F.lit(group)).alias("s"))
    made = F.transform(both, lambda x, i: F.struct(F.lit(k).alias("kind"), i.alias("pos"), F.length(x["p"]).alias("before"), F.length(x["m"]).alias("width"), F.length(x["s"]).alias("secret"), F.sha2(x["s"], 256).alias("hash")))
    return F.when(text.rlike(_QUICK.get(name, pattern)), made).otherwise(F.array().cast(_MATCH))


def _scanned(docs: DataFrame, row: str, matches: str, text_col: str, columns: list[Column | str]) -> DataFrame:
    """``columns`` of each row, a number for it and its matches; staged, so that the numbers hold."""
    found = F.concat(*[_matches(text_or_empty(text_col), k) for k in range(len(KINDS))])
    return stage(docs.select(*columns, F.monotonically_increasing_id().alias(row), found.alias(matches)), "scanned")


def _spans(found: DataFrame) -> DataFrame:
    """row, repo, owner, kind, start, end, from, hash of each span; ``found`` has row, repo, owner and matches."""
    each = found.where(F.size("matches") > 0).select("row", "repo", "owner", F.explode("matches").alias("x")).select("row", "repo", "owner", "x.*")
    ends = F.sum(F.col("before") + F.col("width")).over(Window.partitionBy("row", "kind").orderBy("pos"))
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind") + 1)
    placed = each.withColumn("end", ends).where(F.col("secret") >= least)
    return stage(placed.select("row", "repo", "owner", "kind", (F.col("end") - F.col("width")).alias("start"), "end", (F.col("end") - F.col("secret")).alias("from"), "hash"), "spans")


def frequencies(spans: DataFrame, max_repositories: int = MAX_REPOSITORIES, max_owners: int = MAX_OWNERS) -> DataFrame:
    """hash, n (occurrences), n_repositories, n_owners, live."""
    each = spans.groupBy("hash", "repo", "owner").agg(F.count("*").alias("n"))
    # A count of distinct values would pass over null ones.
    repos = each.groupBy("hash", "repo").agg(F.sum("n").alias("n")).groupBy("hash").agg(F.sum("n").alias("n"), F.count("*").alias("n_repositories"))
    owners = each.groupBy("hash", "owner").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("*").alias("n_owners"))
    return stage(repos.join(owners, "hash").withColumn("live", (F.col("n_repositories") <= max_repositories) & (F.col("n_owners") <= max_owners)), "frequencies")


def judged(spans: DataFrame, max_repositories: int = MAX_REPOSITORIES, max_owners: int = MAX_OWNERS, hot_share: float = HOT_SHARE, hot_least: int = HOT_LEAST) -> DataFrame:
    """The spans with ``live``, without the opaque ones that are widely copied."""
    freq = frequencies(spans, max_repositories, max_owners)
    total = freq.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") >= max(hot_share * total, hot_least)
    known = freq.select("hash", "live", is_hot.alias("hot"))
    hot = F.broadcast(known.where("hot").select("hash", "live"))
    both = spans.join(hot, "hash").unionByName(spans.join(hot, "hash", "left_anti").join(known.where("NOT hot").select("hash", "live"), "hash"))
    return both.where(F.col("live") | (F.col("kind") < 3))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _as_column(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def scan(docs: DataFrame, max_repositories: int = MAX_REPOSITORIES, max_owners: int = MAX_OWNERS, id_col: str = "doc_id", text_col: str = "text", repo_col: Column | str = "source", owner_col: Column | str = "source", **options) -> DataFrame:
    """A row for each row: doc_id, counts by kind, base_sha256, spans, n_live and n_copied of its spans."""
    columns = [F.col(id_col).cast("long").alias("doc_id"), _as_column(repo_col).alias("repo"), _as_column(owner_col).alias("owner")]
    found = _scanned(docs, "row", "matches", text_col, columns)
    seen = judged(_spans(found), max_repositories, max_owners, **options)
    by_row = seen.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("seen"))
    rows = found.select("row", "doc_id").join(by_row, "row", "left").withColumn("seen", F.coalesce("seen", F.array().cast(_SEEN)))
    base = F.filter("seen", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("seen", lambda s: s["kind"] == k)).cast("bigint")
    return rows.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("seen")).alias("spans"),
        F.size(F.filter("seen", lambda s: s["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter("seen", lambda s: ~s["live"])).cast("bigint").alias("n_copied"),
    )


def mask(docs: DataFrame, with_: str = "*", max_repositories: int = MAX_REPOSITORIES, max_owners: int = MAX_OWNERS, text_col: str = "text", repo_col: Column | str = "source", owner_col: Column | str = "source", **options) -> DataFrame:
    """The rows with the secrets of base and live-looking opaque spans replaced, character by character; n_chars follows.

    Rows without matches pass through; the others are cut into blocks, masked block by block, and put together again.
    """
    options.pop("id_col", None)
    row, matches, repo, owner, done = (fresh(docs, x) for x in ("row", "matches", "repo", "owner", "masked"))
    found = _scanned(docs, row, matches, text_col, [*docs.columns, _as_column(repo_col).alias(repo), _as_column(owner_col).alias(owner)])
    plain, some = found.where(F.size(matches) == 0).select(*docs.columns), found.where(F.size(matches) > 0)
    spans = _spans(some.select(F.col(row).alias("row"), F.col(repo).alias("repo"), F.col(owner).alias("owner"), F.col(matches).alias("matches")))
    at = F.col("block") * BLOCK
    each = judged(spans, max_repositories, max_owners, **options).select("row", "from", "end", F.explode(F.sequence(F.floor(F.col("from") / BLOCK), F.floor((F.col("end") - 1) / BLOCK))).alias("block"))
    inside = F.struct(F.greatest(F.col("from") - at, F.lit(0)).cast("int").alias("lo"), F.least(F.col("end") - at, F.lit(BLOCK)).cast("int").alias("hi"))
    masks = each.groupBy("row", "block").agg(F.sort_array(F.collect_set(inside)).alias("masks"))
    pieces = some.select(F.col(row).alias("row"), F.posexplode(F.regexp_extract_all(text_or_empty(text_col), F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))).alias("block", "piece"))

    def step(so_far: Column, m: Column) -> Column:
        start = F.greatest(m["lo"], so_far["at"])
        gap, hidden = F.substring(F.col("piece"), so_far["at"] + 1, start - so_far["at"]), F.repeat(F.lit(with_), F.greatest(m["hi"] - start, F.lit(0)))
        return F.struct(F.greatest(m["hi"], so_far["at"]).alias("at"), F.concat(so_far["out"], gap, hidden).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate("masks", begin, step, lambda x: F.concat(x["out"], F.substring(F.col("piece"), x["at"] + 1, F.lit(BLOCK))))
    covered = pieces.withColumn("block", F.col("block").cast("long")).join(masks, ["row", "block"], "left").select("row", "block", F.coalesce(whole, "piece").alias("piece"))
    texts = covered.groupBy("row").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "piece"))), lambda x: x["piece"]), "").alias(done))
    out = some.join(texts.withColumnRenamed("row", row), row).drop(text_col).withColumnRenamed(done, text_col)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return plain.unionByName(out.select(*docs.columns))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An owner is a source, a repository its part in one language, as the table has nothing nearer to either."""
    return scan(table(spark, sf_dir, "documents"), repo_col=F.to_json(F.struct("source", "lang")))
