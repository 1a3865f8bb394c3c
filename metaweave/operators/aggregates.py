"""Counting operators and replicate detection/removal.

All are grouped aggregations (partial aggregation before the shuffle) or
filters; none collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaweave.functions.nulls import all_null
from metaweave.operators.reshape import keep_first
from metaweave.operators.schema import c


def group_count(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key combination; NULL is its own group."""
    return df.groupBy(*[c(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))


def count_groups(df: DataFrame, fine: Sequence[str], coarse: Sequence[str], name: str = "n") -> DataFrame:
    """Two-level count: number of ``fine`` groups per ``coarse`` group."""
    return group_count(group_count(df, list(fine), "__n"), list(coarse), name)


def pair_count(df: DataFrame, keys: Sequence[str], per: int = 2, name: str = "n") -> DataFrame:
    """Rows per key divided by ``per`` (two files per sample -> samples), as double."""
    return df.groupBy(*[c(k) for k in keys]).agg((F.count(F.lit(1)) / F.lit(per)).alias(name))


def freq_table(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Value frequencies with NULL left out (``table(x)``)."""
    return group_count(df.filter(c(column).isNotNull()), [column], name)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, NULL included as a value."""
    return df.select(c(column)).distinct()


def n_unique(df: DataFrame, column: str, name: str = "n_unique") -> DataFrame:
    """Number of distinct values counting NULL as one value (one-row frame)."""
    return df.agg(
        (F.count_distinct(c(column)) + F.coalesce(F.max(c(column).isNull().cast("long")), F.lit(0))).cast("long").alias(name)
    )


def count_all_null_rows(df: DataFrame, columns: Sequence[str] | None = None, name: str = "n_all_null") -> DataFrame:
    """Rows in which every (listed) column is NULL (one-row frame)."""
    cols = list(columns) if columns is not None else df.columns
    return df.agg(F.count_if(all_null([c(x) for x in cols])).alias(name))


def row_sum(columns: Sequence[str], null_as_zero: bool = True) -> Column:
    """Sum across columns of one row."""
    parts = [F.coalesce(c(x), F.lit(0)) if null_as_zero else c(x) for x in columns]
    return reduce(lambda a, b: a + b, parts)


def having_count(df: DataFrame, keys: Sequence[str], predicate: Callable[[Column], Column],
                 name: str = "n") -> DataFrame:
    """``group_by(keys) %>% summarize(n = n()) %>% filter(pred(n))``."""
    return group_count(df, keys, name).filter(predicate(F.col(name)))


# ----------------------------------------------------------------------------- replicates

def find_replicates(df: DataFrame, key: Column, key_name: str = "replicate_key", min_count: int = 2,
                    extra: Sequence[Column] = ()) -> DataFrame:
    """Derived keys shared by at least ``min_count`` rows: ``(key, n, *extra)``."""
    return (
        df.withColumn(key_name, key)
        .groupBy(key_name)
        .agg(F.count(F.lit(1)).alias("n"), *extra)
        .filter(F.col("n") >= min_count)
    )


def drop_replicates(df: DataFrame, key: Column, rule: str = "first", order_by: Sequence[str] = (),
                    pattern: str | None = None, exclude: DataFrame | None = None,
                    exclude_on: str | None = None, column: str | None = None) -> DataFrame:
    """Remove replicate rows that share a derived key.

    ``rule='first'``: keep the first row per key by ``order_by`` (``keep_first``).
    ``rule='suffix'``: among keys held by more than one row, drop rows whose
    ``column`` matches ``pattern`` (e.g. a second-vial letter ``B$``).
    ``rule='exclude'``: drop rows whose ``column`` is in ``exclude`` (a curated list).
    """
    if rule == "first":
        tagged = df.withColumn("__rkey", key)
        kept = keep_first(tagged, ["__rkey"], list(order_by))
        return kept.select(*[c(x) for x in df.columns])
    if rule == "suffix":
        if pattern is None or column is None:
            raise ValueError("drop_replicates(rule='suffix') needs pattern and column")
        tagged = df.withColumn("__rkey", key)
        reps = tagged.groupBy("__rkey").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1).select(
            F.col("__rkey").alias("__rk"), F.lit(True).alias("__rep"))
        joined = tagged.join(reps, c("__rkey").eqNullSafe(c("__rk")), "left")
        drop = F.coalesce(F.col("__rep"), F.lit(False)) & F.coalesce(c(column).rlike(pattern), F.lit(False))
        return joined.filter(~drop).select(*[c(x) for x in df.columns])
    if rule == "exclude":
        if exclude is None or column is None:
            raise ValueError("drop_replicates(rule='exclude') needs exclude and column")
        from metaweave.operators.joins import restrict_to

        return restrict_to(df, exclude, column, ids_on=exclude_on, keep=False)
    raise ValueError(f"drop_replicates: unknown rule {rule!r}")
