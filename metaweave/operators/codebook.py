"""Codes that stay: a stored dictionary that grows, and whose numbers never change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaweave.operators.ids import _placed
from metaweave.operators.schema import c
from metaweave.session import materialize
from metaweave.sources.published import manifest, publish, read_all_versions

NAME = "codes"


def code_table(spark: SparkSession, place: str) -> DataFrame | None:
    """``(value, code)`` of the dictionary at ``place``, None before its first values."""
    return read_all_versions(spark, place, NAME)


def extend_codes(df: DataFrame, column: str, place: str) -> int:
    """Give every new non-NULL value of ``column`` the next number; how many there were is returned.

    The first load numbers its different values from 1 in their order, each later one those it brings, in their order,
    from the largest number on. Numbers given before stay. Only new values are sorted, numbered and written: each load
    publishes an increment through a manifest, so a load that fails leaves the dictionary as it was, and one that is
    repeated finds nothing new and publishes nothing. Values are compared in the type of the first load.
    """
    spark = df.sparkSession
    known = code_table(spark, place)
    values = df.select(c(column).alias("value")).where(F.col("value").isNotNull())
    if known is not None:
        values = values.select(F.col("value").cast(known.schema["value"].dataType))
    values = values.distinct()
    if known is not None:
        values = values.join(known.select("value"), "value", "left_anti")
    values = materialize(values)
    n = values.count()
    if n:
        taken = manifest(spark, place).where(F.col("name") == NAME).agg(F.sum("rows")).first()[0] or 0
        placed = _placed(values, ["value"])
        publish({NAME: placed.select("value", (F.col("__at") + taken).alias("code"))}, place)
    return n


def encode(df: DataFrame, column: str, place: str, out: str, prefix: str | None = None) -> DataFrame:
    """Add the stored code of ``column`` as ``out``; NULL for NULL and for values that the dictionary lacks.

    With ``prefix`` the code is text (``NEW_7``). A left join on the value; a skewed value is split on the left.
    """
    known = code_table(df.sparkSession, place)
    if known is None:
        return df.withColumn(out, F.lit(None).cast("string" if prefix is not None else "long"))
    code = F.concat(F.lit(prefix), F.col("code").cast("string")) if prefix is not None else F.col("code")
    table = known.select(F.col("value").alias("__value"), code.alias("__code"))
    joined = df.join(table, c(column) == F.col("__value"), "left")
    return joined.select(*[c(x) for x in df.columns if x != out], F.col("__code").alias(out))
