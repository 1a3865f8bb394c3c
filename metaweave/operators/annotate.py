"""Cross-assay annotation and registry id attachment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaweave.operators.joins import flag_membership, join_on
from metaweave.operators.reshape import keep_first
from metaweave.operators.schema import c, prefix_names


def annotate_match(
    df: DataFrame,
    other: DataFrame,
    out: str,
    exact: tuple[str, str],
    coarse: tuple[str, str] | None = None,
    exact_derive: Callable[[Column], Column] | None = None,
    coarse_derive: Callable[[Column], Column] | None = None,
    labels: tuple[str, str] = ("MATCHED", "DISTANT"),
) -> DataFrame:
    """Label each row by whether ``other`` holds the same sample or only the same donor.

    ``exact=(col_in_df, col_in_other)`` is the sample-level key, ``coarse`` the
    donor-level key; ``*_derive`` derive the key on both sides (e.g. drop the vial
    letter). Result: ``labels[0]`` for a sample match, else ``labels[1]`` for a donor
    match, else NULL. Two left joins to distinct keys; rows never multiply.
    """
    flagged = flag_membership(df, other, exact[0], "__exact", ids_on=exact[1], derive=exact_derive)
    label = F.when(F.col("__exact"), F.lit(labels[0]))
    drop = ["__exact"]
    if coarse is not None:
        flagged = flag_membership(flagged, other, coarse[0], "__coarse", ids_on=coarse[1], derive=coarse_derive)
        label = label.when(F.col("__coarse"), F.lit(labels[1]))
        drop.append("__coarse")
    return flagged.withColumn(out, label).drop(*drop)


def annotate_levels(df: DataFrame, other: DataFrame, out: str, levels: Sequence[tuple[str, str | Column, str | Column]]) -> DataFrame:
    """Label each row by the finest of any number of key levels on which ``other`` holds a match.

    ``levels`` lists ``(label, key in df, key in other)`` from the finest to the coarsest; a key is a column name or an
    expression over it (a barcode without its vial, say). ``out`` is the label of the first level whose key occurs in
    ``other``, NULL if none does. A NULL key matches nothing. Rows are neither lost nor multiplied.

    The plan has two joins at any number of levels. All keys of ``other`` form one index of different (level, key)
    pairs, read in one pass; the different key tuples of ``df`` meet it in one equi-join, and the smallest level of each
    tuple is joined back to the rows. A key that many rows share counts once in the first join, and is on the left of
    the second, where skewed partitions are split.
    """
    if not levels:
        raise ValueError("annotate_levels: no levels")
    if out in df.columns:
        raise ValueError(f"annotate_levels: column {out!r} is there already")

    def keys(side: int, name: str = "__key") -> list[Column]:
        exprs = [level[side] if isinstance(level[side], Column) else c(level[side]) for level in levels]
        return [x.cast("string").alias(f"{name}{i}") for i, x in enumerate(exprs)]

    def pairs(frame: DataFrame, *carried: Column) -> DataFrame:
        each = F.array(*[F.struct(F.lit(i).alias("__level"), F.col(f"__key{i}").alias("__key")) for i in range(len(levels))])
        return frame.select(*carried, F.inline(each)).where(F.col("__key").isNotNull())

    index = pairs(other.select(*keys(2))).distinct()
    names = [f"__key{i}" for i in range(len(levels))]
    tuples = df.select(*keys(1)).distinct()
    found = pairs(tuples, *[F.col(x).alias(f"__of{i}") for i, x in enumerate(names)]).join(index, ["__level", "__key"])
    best = found.groupBy(*[f"__of{i}" for i in range(len(levels))]).agg(F.min("__level").alias("__best"))
    rows = df.select("*", *keys(1))
    same = [F.col(x).eqNullSafe(F.col(f"__of{i}")) for i, x in enumerate(names)]
    condition = same[0]
    for x in same[1:]:
        condition = condition & x
    label = F.element_at(F.array(*[F.lit(level[0]) for level in levels]), F.col("__best") + 1)
    joined = rows.join(best, condition, "left")
    return joined.select(*[c(x) for x in df.columns], F.when(F.col("__best").isNotNull(), label).alias(out))


def attach_registry(
    df: DataFrame,
    registry: DataFrame,
    on: tuple[str, str],
    replace: dict[str, str] | None = None,
    prefix: str = "",
    keep: Sequence[str] | None = None,
    dedupe_order: Sequence[str] | None = None,
) -> DataFrame:
    """Left join registry ids; a registry id wins over the placeholder in ``df``.

    ``on=(df_column, registry_column)``. Registry columns are renamed with
    ``prefix``. ``replace={df_column: registry_column}`` overwrites the placeholder
    with ``coalesce(registry value, placeholder)``. A registry that is not unique
    on its key multiplies rows; pass ``dedupe_order`` to keep the first entry per key.
    """
    reg = registry
    if dedupe_order is not None:
        reg = keep_first(reg, [on[1]], list(dedupe_order))
    if keep is not None:
        reg = reg.select(*[c(x) for x in dict.fromkeys([on[1], *keep])])
    reg = prefix_names(reg, prefix) if prefix else reg
    key = prefix + on[1]
    # Registry columns named like a column of df (compared case-insensitively, as
    # Spark resolves names) are joined under a temporary name and resolved below.
    taken = {x.lower() for x in df.columns}
    tmp = {x: f"__reg_{i}" for i, x in enumerate(reg.columns) if x != key and x.lower() in taken}
    reg = reg.withColumnsRenamed(tmp) if tmp else reg
    joined = join_on(df, reg, {on[0]: key}, how="left")
    for target, source in (replace or {}).items():
        src = tmp.get(prefix + source, prefix + source)
        joined = joined.withColumn(target, F.coalesce(c(src), c(target)))
    leftover = [t for t in tmp.values() if t in joined.columns]
    return joined.drop(*leftover) if leftover else joined
