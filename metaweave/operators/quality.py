"""Profiling and count reconciliation, as tall DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from metaweave.operators.schema import c
from metaweave.session import materialize

NUMERIC_METRICS = ("mean", "sd", "p0", "p25", "p50", "p75", "p100")


QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True, accuracy: int = 10_000,
            rsd: float = 0.01) -> DataFrame:
    """Per-column metrics ``(column, metric, value)``.

    Every column: ``n_missing``, ``complete_rate`` (NULL for an empty table), ``n_unique`` (non-NULL values).
    Numeric columns add ``mean``, ``sd`` and the quantiles ``p0`` to ``p100`` (the value at rank
    ``ceil(q * n)``).

    ``exact`` counts every different value once (partial aggregation) and takes distinct counts and
    quantiles from these counts at any size: the different values are range-sorted, and ranks are
    running sums within a partition plus the sums of the partitions before. Without ``exact`` they come from
    one pass over the rows, and say so in their names: ``n_unique_approx`` (relative error ``rsd``) and
    ``p25_approx`` ... (rank error about n / ``accuracy``).
    """
    cols = list(columns) if columns is not None else df.columns
    numeric = [x for x in cols if isinstance(df.schema[x].dataType, NumericType)]
    aggs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    entries: list[Column] = []

    def entry(x: str, metric: str, value: Column) -> None:
        entries.append(F.struct(F.lit(x).alias("column"), F.lit(metric).alias("metric"), value.cast("double").alias("value")))

    for i, x in enumerate(cols):
        aggs.append(F.count_if(c(x).isNull()).alias(f"m{i}"))
        entry(x, "n_missing", F.col(f"m{i}"))
        entry(x, "complete_rate", F.lit(1.0) - F.try_divide(F.col(f"m{i}"), F.col("__rows")))
        if not exact:
            aggs.append(F.approx_count_distinct(c(x), rsd).alias(f"u{i}"))
            entry(x, "n_unique_approx", F.col(f"u{i}"))
        if x in numeric:
            v = c(x).cast("double")
            aggs += [F.avg(v).alias(f"a{i}"), F.stddev_samp(v).alias(f"s{i}"), F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}")]
            for metric, field in (("mean", "a"), ("sd", "s"), ("p0", "l"), ("p100", "h")):
                entry(x, metric, F.col(f"{field}{i}"))
            if not exact:
                aggs.append(F.percentile_approx(v, list(QUANTILES.values()), accuracy).alias(f"q{i}"))
                for k, metric in enumerate(QUANTILES):
                    entry(x, f"{metric}_approx", F.col(f"q{i}")[k])
    out = df.agg(*aggs).select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    if not exact:
        return out
    counts = materialize(
        long_values(df, cols).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    named = F.broadcast(df.sparkSession.createDataFrame([(x,) for x in cols], "column string"))
    different = counts.groupBy("column").agg(F.count(F.lit(1)).cast("double").alias("value"))
    different = named.join(different, "column", "left").select(
        "column", F.lit("n_unique").alias("metric"), F.coalesce("value", F.lit(0.0)).alias("value")
    )
    out = out.unionByName(different)
    if not numeric:
        return out
    asked = df.sparkSession.createDataFrame([(x, m, q) for x in numeric for m, q in QUANTILES.items()], "column string, metric string, q double")
    found = _at_ranks(counts.filter(F.col("column").isin(numeric)), asked)
    missing = F.broadcast(asked).join(found, ["column", "metric"], "left").select("column", "metric", "value")
    return out.unionByName(missing)


def _at_ranks(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """``(column, metric, value)``: the value at rank ``ceil(q * n)`` of each column's counted values."""
    n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    typed = counts.select("column", F.col("value").cast("double").alias("value"), "n")
    placed = materialize(typed.repartitionByRange(n, "column", "value").withColumn("part", F.spark_partition_id()))
    sums = placed.groupBy("column", "part").agg(F.sum("n").alias("rows"))
    # one row per partition and column; a column's partitions follow its order of values
    w = Window.partitionBy("column").orderBy("part")
    sums = sums.select(
        "column", "part", (F.sum("rows").over(w) - F.col("rows")).alias("before"), F.sum("rows").over(Window.partitionBy("column")).alias("total")
    )
    inside = Window.partitionBy("column", "part").orderBy("value")
    ranked = placed.join(sums, ["column", "part"]).withColumn("last", F.col("before") + F.sum("n").over(inside))
    hit = (F.ceil(F.col("q") * F.col("total")) <= F.col("last")) & (F.ceil(F.col("q") * F.col("total")) > F.col("last") - F.col("n"))
    return ranked.join(F.broadcast(asked), "column").where(hit).select("column", "metric", "value")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 8) -> DataFrame:
    """``(column, bin, n)``: how many values lie in each of ``bins`` equal parts of a column's range.

    Bins are numbered from 1; the largest value is in the last one, and equal values all in the first.
    A column without values has no row; empty bins have ``n`` 0.
    """
    typed = df.select(*[c(x).cast("double").alias(x) for x in columns]).unpivot([], list(columns), "column", "value")
    typed = typed.filter(F.col("value").isNotNull())
    ranges = typed.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    place = F.coalesce(F.floor(F.try_divide((F.col("value") - F.col("lo")) * bins, F.col("hi") - F.col("lo"))), F.lit(0))
    placed = typed.join(F.broadcast(ranges), "column").select("column", (F.least(place, F.lit(bins - 1)) + 1).cast("int").alias("bin"))
    counted = placed.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    every = ranges.select("column", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return every.join(counted, ["column", "bin"], "left").select("column", "bin", F.coalesce("n", F.lit(0)).alias("n"))


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value)`` with every value rendered as text (Spark ``unpivot``)."""
    typed = df.select(*[c(x).cast(StringType()).alias(x) for x in columns])
    return typed.unpivot([], list(columns), "column", "value")


def top_values(df: DataFrame, columns: Sequence[str], k: int = 4) -> DataFrame:
    """The ``k`` most frequent non-NULL values per column: ``(column, value, n, rank)``.

    Ties are broken by value. Spark plans the rank filter as a per-partition group
    limit before the shuffle, so a high-cardinality column does not move all its
    distinct values to one task.
    """
    counts = long_values(df, columns).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value").asc())
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def reconcile(df: DataFrame, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Evaluate ``(name, expected aggregate, actual aggregate)`` in one pass.

    Returns ``(check, expected, actual, ok)`` with counts as long.
    """
    aggs = []
    for i, (_, expected, actual) in enumerate(checks):
        aggs += [expected.cast("long").alias(f"e{i}"), actual.cast("long").alias(f"a{i}")]
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(f"e{i}").alias("expected"), F.col(f"a{i}").alias("actual"))
        for i, (name, _, _) in enumerate(checks)
    ])
    out = wide.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))
