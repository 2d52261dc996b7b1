"""Sources (A1-A3): CSV groups, parquet tables, inline arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twosample.operators.prepare import coerce_lenient, coerce_strict, is_usable
from twosample.sources.positions import first_rows, with_positions

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A driver table ``<root>/<name>.parquet`` (column pruning and filter
    pushdown reach the scan)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def first_column(df: DataFrame, column: str | None = None) -> str:
    """A3: an unnamed column means the first column (schema only, no job)."""
    if column:
        if column not in df.columns:
            raise ValueError(f"column {column!r} not found")
        return column
    if not df.columns:
        raise ValueError("input has no columns")
    return df.columns[0]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A1 scan: headed CSV (CRLF accepted).  Without a schema all columns are text, so
    only the header line is read ahead and a later projection parses one column."""
    r = spark.read.option("header", True)
    return (r.schema(schema) if schema is not None else r).csv(path)


def column_profile(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """A1 types: what a text column holds, from one aggregate of that column: ``rows,
    missing, whole, fraction, boolean, other, inferred`` (per ``by`` key).  ``inferred`` is
    the narrowest type that holds all values: bigint, double, boolean, string, or void
    if there are none.  NaN and infinities are fractions."""
    c = F.col(column).cast("string")
    text = F.trim(c)
    number = text.try_cast("double")
    kind = (F.when(c.isNull() | (text == ""), "missing").when(text.try_cast("bigint").isNotNull() & ~text.rlike("[.eE]"), "whole")
            .when(number.isNotNull(), "fraction").when(F.lower(text).isin("true", "false"), "boolean").otherwise("other"))
    kinds = ("missing", "whole", "fraction", "boolean", "other")
    n = df.select(*by, kind.alias("_kind")).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(F.when(F.col("_kind") == k, 1)).alias(k) for k in kinds])
    present = F.col("rows") - F.col("missing")
    return n.withColumn("inferred", F.when(present == 0, "void").when(F.col("whole") == present, "bigint")
                        .when(F.col("whole") + F.col("fraction") == present, "double")
                        .when(F.col("boolean") == present, "boolean").otherwise("string"))


def csv_group(spark: SparkSession, path: str, column: str | None = None,
              schema: T.StructType | str | None = None, strict: bool = False, positions: bool = False,
              head: int | None = None) -> DataFrame:
    """A1: one CSV column as a numeric sample ``(value)``; non-numeric text is
    an error when ``strict`` (B1) or dropped (B2); missing values dropped (B3).

    ``positions`` adds ``pos``, the value's place among the usable values in file order;
    ``head`` keeps the first so many of them (B4) and reads no later files."""
    df = read_csv(spark, path, schema)
    col = first_column(df, column)
    cast = coerce_strict if strict else coerce_lenient
    out = df.select(cast(F.col(f"`{col}`")).alias("value")).filter(is_usable(F.col("value")))
    if head is not None:
        out = first_rows(out, head)
        return out if positions else out.drop("pos")
    return with_positions(out) if positions else out


def csv_groups(spark: SparkSession, path1: str, path2: str, column1: str | None = None,
               column2: str | None = None, strict: bool = False,
               labels: Sequence[str] = ("group1", "group2"), schema: T.StructType | str | None = None,
               positions: bool = False, head: int | None = None) -> DataFrame:
    """Two CSV files as one ``(grp, value)`` table, ready for ``two_sample``; with
    ``positions`` as ``(grp, pos, value)``, ready for ``paired`` and the chi-square test by position."""
    a = csv_group(spark, path1, column1, schema, strict, positions, head).withColumn("grp", F.lit(labels[0]))
    b = csv_group(spark, path2, column2, schema, strict, positions, head).withColumn("grp", F.lit(labels[1]))
    return a.unionByName(b)


def inline_groups(spark: SparkSession, group1: Sequence[float],
                  group2: Sequence[float] | None = None,
                  labels: Sequence[str] = ("group1", "group2")) -> DataFrame:
    """A2: request arrays as ``(grp, pos, value)`` rows via ``posexplode``.

    The arrays arrive on the driver as part of a request, so they are small
    by construction; everything after this is the same distributed plan.
    """
    schema = "grp string, vals array<double>"
    rows = [(labels[0], [float(x) for x in group1])]
    if group2 is not None:
        rows.append((labels[1], [float(x) for x in group2]))
    df = spark.createDataFrame(rows, schema)
    return df.select("grp", F.posexplode("vals").alias("pos", "value"))


def inline_json(spark: SparkSession, payload: str) -> DataFrame:
    """A2 from JSON text ``{"group1": [...], "group2": [...]}`` parsed with
    ``from_json`` on the executors."""
    return json_groups(spark.createDataFrame([(payload,)], "payload string"), "payload")


def json_groups(df: DataFrame, column: str, labels: Sequence[str] = ("group1", "group2"),
                keep: Sequence[str] = ()) -> DataFrame:
    """A2 at scale: a column of request payloads ``{"group1": [...],
    "group2": [...]}`` parsed once each on the executors (``from_json``) and
    exploded to ``(keep..., grp, pos, value)`` rows.  With a request id in
    ``keep`` and in the test's ``by`` keys, every payload is its own test."""
    schema = ", ".join(f"`{lab}` array<double>" for lab in labels)
    parsed = df.select(*keep, F.from_json(F.col(column), schema).alias("j"))
    sides = F.array(*[F.struct(F.lit(lab).alias("grp"), F.col("j")[lab].alias("vals")) for lab in labels])
    return (parsed.select(*keep, F.explode(sides).alias("s"))
            .select(*keep, F.col("s.grp").alias("grp"), F.posexplode("s.vals").alias("pos", "value")))
