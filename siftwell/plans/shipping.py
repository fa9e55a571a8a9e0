"""Gives the executors' Python workers this package where it is not installed on them."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


#: Rows of a batch that goes to a Python worker, and Spark's own number, which is many MB where rows are documents.
_BATCH, BATCH_ROWS, SPARKS_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "2000", "10000"


def ship(spark: SparkSession) -> None:
    """Add the package's source to the session's Python files, once for each application; keep batches for workers small.

    A session that sets another size of batches keeps it.
    """
    if spark.conf.get(_BATCH) == SPARKS_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    _SENT.add(context.applicationId)
    root = Path(__file__).resolve().parents[1]
    handle, path = tempfile.mkstemp(prefix="siftwell-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(path)
