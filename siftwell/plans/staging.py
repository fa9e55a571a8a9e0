"""Stage boundaries: intermediate tables in the cluster's shared checkpoint folder.

A staged table cuts lineage without local checkpoints: it survives lost executors, because every executor can read the
folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import atexit
import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_UNKNOWN = 1 << 56
#: Bytes that a task buffers before it writes them.
BLOCK_BYTES = 32 << 20
_STAGED: list[tuple[SparkSession, str]] = []
_SCRATCH: ContextVar[tuple[list[tuple[SparkSession, str]], ...]] = ContextVar("scratch", default=())


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset, as in tests, an own folder is set for this session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="siftwell-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def stage(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    ``keep`` lets the table outlive the innermost enclosing ``scratch``; it then belongs to the one around that, if any.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/siftwell/{label}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", BLOCK_BYTES).parquet(path)
    around = _SCRATCH.get()[: -1 if keep else None]
    if around:
        around[-1].append((spark, path))
    else:
        if not _STAGED:
            atexit.register(release)
        _STAGED.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch() -> Iterator[None]:
    """Tables staged inside are deleted at the end, so only what is staged with ``keep`` may be read after it."""
    tables: list[tuple[SparkSession, str]] = []
    token = _SCRATCH.set((*_SCRATCH.get(), tables))
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for spark, path in tables:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release() -> None:
    """Delete every staged table of this process."""
    while _STAGED:
        spark, path = _STAGED.pop()
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone already
            return


def input_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df``, which for file sources is the size of the files; no job runs.

    Where the plan has no estimate, the rows are measured.
    """
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate < _UNKNOWN:
        return estimate
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0] or 0


def partitions_for(df: DataFrame, bytes_each: int, least: int | None = None) -> int:
    """How many equal parts of about ``bytes_each`` input bytes ``df`` has, never fewer than the shuffle partitions."""
    floor = least or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, math.ceil(input_bytes(df) / bytes_each))
