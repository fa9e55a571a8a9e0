"""Scalar expressions that several operators share."""

from __future__ import annotations

from pathlib import Path
from urllib.parse import unquote, urlparse

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(dataset_id: str, uri: Column, given: Column) -> Column:
    """The given id, or 16 hexadecimal digits of the dataset's and the uri's digest where it is missing or empty."""
    return F.coalesce(F.nullif(given, F.lit("")), F.substring(F.sha1(F.concat_ws(":", F.lit(dataset_id), uri)), 1, 16))


def review_task_id(run_id: str, image_id: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws(":", F.lit(run_id), image_id)), 1, 16)


def sampled(image_id: Column, ratio: float) -> Column:
    """A deterministic sample by id: none at 0 or below, all at 1 or above."""
    if ratio <= 0 or ratio >= 1:
        return F.lit(ratio > 0)
    return F.conv(F.substring(F.sha1(image_id), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0) < ratio


def confidence_bucket(confidence: Column) -> Column:
    return (
        F.when(confidence >= 0.95, "0.95-1.00").when(confidence >= 0.9, "0.90-0.95").when(confidence >= 0.8, "0.80-0.90").when(confidence >= 0.6, "0.60-0.80").otherwise("0.00-0.60")
    )


def local_uri(value: str) -> str:
    """Paths become absolute file uris, file uris are resolved, others stay."""
    scheme = urlparse(value).scheme
    if scheme and scheme != "file":
        return value
    path = unquote(urlparse(value).path) if scheme else value
    return Path(path).expanduser().resolve().as_uri()


def local_path(uri: str) -> str | None:
    parsed = urlparse(uri)
    return unquote(parsed.path) if parsed.scheme in ("", "file") else None


def unit(vector: Column, floor: float = 1e-12) -> Column:
    """The vector in double precision, divided by its length or by ``floor`` if that is larger."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(wide, lambda x: x / F.greatest(length, F.lit(floor)))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
