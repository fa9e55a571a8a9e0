"""Reading the tables that the queries use, and text columns as the operators want them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(*columns: Column) -> Column:
    """A hash of what a row holds; rows that agree in all columns share it."""
    return F.xxhash64(*columns)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
