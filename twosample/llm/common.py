"""Helpers shared by the operators: the shared folder, lineage cuts, hashes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share.

    Only where that setting is absent and the master is local (tests) a
    temporary folder is chosen and set for the session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile
        base = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a lineage cut that
    survives the loss of executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(col: Column | str) -> Column:
    """Lower-cases A-Z only; every other character stays."""
    return F.translate(F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")),
                       UPPER, UPPER.lower())


def id_remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def partitions_for(rows: int, per_task: int, least: int) -> int:
    """Tasks so that each gets about ``per_task`` rows, ``least`` at least."""
    return max(least, -(-rows // per_task))
