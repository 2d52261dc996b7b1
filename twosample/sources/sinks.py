"""Result sink (A4): results are ordinary DataFrames, written by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_json(df: DataFrame) -> Column:
    """Each result row as one JSON document (nested structs kept)."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]))


def write_results(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Write a result DataFrame (json lines or parquet) from the executors."""
    df.write.mode(mode).format(fmt).save(path)
