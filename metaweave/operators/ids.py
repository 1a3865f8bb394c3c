"""Global numbering without a single-partition window.

``row_number()``/``dense_rank()`` over an unpartitioned window moves every row
into one task. Here the rows are range-partitioned and sorted by the ordering
key, tagged with ``monotonically_increasing_id`` (partition index in the upper
bits, position in the lower bits), and written to the session's checkpoint
folder so the numbering cannot change if a stage is recomputed after an executor
is lost. Per-partition counts (one row per partition) then give each partition
its offset; that table is bounded by the partition count, so broadcasting it is
safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaweave.operators.schema import c
from metaweave.session import materialize

_PID_SHIFT = 33  # monotonically_increasing_id puts the partition index above bit 33


def _placed(df: DataFrame, order_by: Sequence[str], group: str | None = None, partitions: int | None = None) -> DataFrame:
    """Rows in range partitions of ``order_by``, written once, with ``__at``: the 1-based place (within ``group``).

    The written partitions are contiguous, so a row's place is its position in the partition plus the
    rows of the group before. Those counts, one row per partition and group, are read once (bounded by
    ``partitions`` times the number of groups) and joined as a literal table.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A final tie-break lets the range partitioner split runs of identical rows;
    # which of several identical rows gets which number does not change the result.
    keyed = df.withColumn("__tb", F.monotonically_increasing_id())
    sort_cols = [c(x).asc_nulls_first() for x in order_by] + [F.col("__tb")]
    ordered = keyed.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols).drop("__tb")
    tagged = materialize(ordered.withColumn("__mono", F.monotonically_increasing_id()))
    pid, kind = F.shiftright(F.col("__mono"), _PID_SHIFT), c(group) if group else F.lit(0)
    parts = tagged.groupBy(pid.alias("p"), kind.alias("g")).agg(F.min("__mono").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    before: dict = {}
    rows = []
    for r in sorted(parts, key=lambda r: r["p"]):
        rows.append((r["p"], r["g"], before.get(r["g"], 0) - r["first"] + 1))
        before[r["g"]] = before.get(r["g"], 0) + r["n"]
    base = spark.createDataFrame(rows, "__p long, __g int, __base long")
    out = tagged.join(F.broadcast(base), (pid == F.col("__p")) & (kind == F.col("__g")))
    return out.withColumn("__at", F.col("__mono") + F.col("__base")).drop("__mono", "__p", "__g", "__base")


def with_row_index(df: DataFrame, order_by: Sequence[str], name: str = "row_index") -> DataFrame:
    """Add 1..N in ``order_by`` order (ascending, NULLs first).

    Rows that tie on ``order_by`` are ordered by the remaining columns, so the
    numbering is total and repeatable.
    """
    order = list(order_by) + [x for x in df.columns if x not in order_by]
    return _placed(df, order).select(*[c(x) for x in df.columns], F.col("__at").alias(name))


def dense_code(df: DataFrame, column: str, out: str, prefix: str | None = "NEW_") -> DataFrame:
    """Dense 1..K code of the sorted distinct non-NULL values of ``column``.

    ``as.numeric(as.factor(x))``; with ``prefix`` the code is text (``NEW_7``). NULL
    stays NULL. Only the distinct values are sorted and numbered; the codes are
    joined back on the value (AQE broadcasts the code table when it is small and
    splits a skewed value on the left side otherwise). Sort order is binary
    (UTF-8 bytes), not locale order.
    """
    return dense_codes(df, [column], outs=[out], prefix=prefix)


def dense_codes(df: DataFrame, columns: Sequence[str], suffix: str = "_code", outs: Sequence[str] | None = None,
                prefix: str | None = None) -> DataFrame:
    """``dense_code`` for several columns with one numbering pass.

    The distinct ``(column, value)`` pairs of all columns are numbered together in ``(column, value)``
    order and written once; values keep their type (one field per type), so numbers sort
    numerically. The table of codes is joined once per column.
    """
    columns = list(columns)
    outs = list(outs) if outs is not None else [x + suffix for x in columns]
    kinds = [df.schema[x].dataType.simpleString() for x in columns]
    fields = {kind: f"__v{k}" for k, kind in enumerate(dict.fromkeys(kinds))}
    pairs = None
    for i, (x, kind) in enumerate(zip(columns, kinds)):
        values = [(c(x) if k == kind else F.lit(None)).cast(k).alias(v) for k, v in fields.items()]
        part = df.filter(c(x).isNotNull()).select(F.lit(i).alias("__c"), *values)
        pairs = part if pairs is None else pairs.unionByName(part)
    codes = _placed(pairs.distinct(), ["__c", *fields.values()], group="__c")
    out = df
    for i, (x, kind) in enumerate(zip(columns, kinds)):
        code = F.concat(F.lit(prefix), F.col("__at").cast("string")) if prefix is not None else F.col("__at")
        table = codes.filter(F.col("__c") == i).select(F.col(fields[kind]).alias(f"__k{i}"), code.alias(outs[i]))
        out = out.join(table, c(x) == F.col(f"__k{i}"), "left").drop(f"__k{i}")
    return out.select(*[c(x) for x in df.columns], *[c(x) for x in outs])
