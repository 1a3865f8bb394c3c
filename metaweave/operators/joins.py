"""Joins with data-frame-language semantics: NULL keys match each other.

Every join here is an equi-join, so Spark keeps its hash/sort-merge strategies and
AQE decides broadcast at run time from measured sizes. No helper forces a
broadcast of a side whose size grows with the data.

Skew. A key that holds a large share of the rows (a NULL-safe NULL key is one)
lands on one reducer. AQE's skew-join handling splits such a partition on either
side of an inner join, and on the left side of left outer, semi and anti joins (a
hot key on the right side of a left outer join stays whole). It cannot split full
outer joins, so ``full`` joins run as an inner join plus two anti joins against
distinct keys. Id sets are de-duplicated before semi/anti joins, so a hot
key on the id side collapses in the map-side partial aggregation.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from metaweave.operators.schema import c
from metaweave.session import materialize

#: Rows of a table with the same key that an N-way join gathers in one place.
CELL_ROWS = 10_000
#: Hot keys that are listed in the plan; more of them are joined as a table.
HOT_LISTED = 10_000

_HOW = {"inner", "left", "right", "full", "left_semi", "left_anti"}


# ----------------------------------------------------------------------------- key discovery

def shared_keys(*frames: DataFrame, pattern: str | None = "id") -> list[str]:
    """Column names present in every frame (order of the first), kept if they contain ``pattern``."""
    if not frames:
        return []
    names = list(frames[0].columns)
    for f in frames[1:]:
        present = set(f.columns)
        names = [n for n in names if n in present]
    if pattern:
        rx = re.compile(pattern)
        names = [n for n in names if rx.search(n)]
    return names


def check_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    """Raise if ``keys`` repeat in ``df`` (guards a many-to-one join against fan-out).

    One whole aggregation job, with partial aggregation; only one repeated key comes to the driver.
    """
    dup = df.groupBy(*[c(k) for k in keys]).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"{what} is not unique on {list(keys)}: e.g. {dup[0].asDict()}")
    return df


# ----------------------------------------------------------------------------- core join

def _name_norm(df: DataFrame) -> Callable[[str], str]:
    sensitive = str(df.sparkSession.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"
    return (lambda x: x) if sensitive else str.lower


def join_na(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
            right_keys: Sequence[str] | None = None, suffix: tuple[str, str] = ("_x", "_y"),
            null_equal: bool = True, skew_safe_full: bool = True) -> DataFrame:
    """Join on ``keys`` (right side may name them ``right_keys``); left names survive.

    ``null_equal`` makes NULL match NULL. Non-key columns present on both sides get
    ``suffix``. Output: left columns (keys in place), then right non-key columns.
    For ``full`` the key is ``coalesce(left, right)``; with ``skew_safe_full`` (default)
    both inputs are written once to the shared folder and it runs as an inner join plus the rows
    of either side without a partner, which AQE's skew handling can split whichever
    side a hot key is on, instead of one full outer join, which it cannot.
    """
    if how not in _HOW:
        raise ValueError(f"join_na: unknown how={how!r}")
    keys = list(keys)
    rkeys = list(right_keys) if right_keys is not None else keys
    if not keys or len(keys) != len(rkeys):
        raise ValueError("join_na: need the same, non-zero number of keys on both sides")
    for k in keys:
        if k not in left.columns:
            raise KeyError(f"join_na: left has no column {k!r}")
    for k in rkeys:
        if k not in right.columns:
            raise KeyError(f"join_na: right has no column {k!r}")

    semi = how in ("left_semi", "left_anti")
    r_other = [x for x in right.columns if x not in rkeys]
    # Non-key names on both sides get a suffix on both; a right column named like a
    # left key gets the right suffix only (the key keeps its name). Names are
    # compared the way the session resolves them (case-insensitive by default).
    norm = _name_norm(left)
    l_other = {norm(x) for x in left.columns if x not in keys}
    l_keys = {norm(x) for x in keys}
    clash = set() if semi else {norm(x) for x in r_other if norm(x) in l_other}
    shadow = set() if semi else {norm(x) for x in r_other if norm(x) in l_keys}

    lmap = {x: (x + suffix[0] if norm(x) in clash else x) for x in left.columns}
    rtmp = [f"__rk{i}" for i in range(len(rkeys))]
    rmap = {x: (x + suffix[1] if norm(x) in clash or norm(x) in shadow else x) for x in r_other}

    lsel = left.select(*[c(x).alias(lmap[x]) for x in left.columns])
    rsel = right.select(*[c(k).alias(t) for k, t in zip(rkeys, rtmp)], *[c(x).alias(rmap[x]) for x in r_other])
    lk = [lmap[k] for k in keys]

    def joined(l_df: DataFrame, r_df: DataFrame, safe: bool, how: str = how) -> DataFrame:
        conds = [(c(a).eqNullSafe(c(b)) if safe else c(a) == c(b)) for a, b in zip(lk, rtmp)]
        cond = reduce(lambda a, b: a & b, conds)
        out = l_df.join(r_df, cond, how)
        if semi:
            return out
        cols = []
        for x in left.columns:
            name = lmap[x]
            if x in keys:
                t = rtmp[keys.index(x)]
                if how == "full":
                    cols.append(F.coalesce(c(name), c(t)).alias(name))
                elif how == "right":
                    cols.append(c(t).alias(name))
                else:
                    cols.append(c(name))
            else:
                cols.append(c(name))
        cols += [c(rmap[x]) for x in r_other]
        return out.select(*cols)

    if how == "full" and skew_safe_full:
        # full = matching pairs + left rows without a partner + right rows without one. AQE splits a
        # skewed partition on either side of an inner join, and on the left of an anti join, whose
        # right side here holds every key once. Each input is evaluated once.
        lsel, rsel = materialize(lsel), materialize(rsel)

        def lonely(df: DataFrame, own: list[str], other: DataFrame, theirs: list[str]) -> DataFrame:
            ids = other.select(*[c(k).alias(f"__o{i}") for i, k in enumerate(theirs)]).distinct()
            conds = [(c(k).eqNullSafe(c(f"__o{i}")) if null_equal else c(k) == c(f"__o{i}")) for i, k in enumerate(own)]
            return df.join(ids, reduce(lambda x, y: x & y, conds), "left_anti")

        left_only = lonely(lsel, lk, rsel, rtmp).select(
            *[c(lmap[x]) for x in left.columns],
            *[F.lit(None).cast(rsel.schema[rmap[x]].dataType).alias(rmap[x]) for x in r_other],
        )
        right_only = lonely(rsel, rtmp, lsel, lk).select(
            *[(c(rtmp[keys.index(x)]) if x in keys else F.lit(None).cast(left.schema[x].dataType)).alias(lmap[x]) for x in left.columns],
            *[c(rmap[x]) for x in r_other],
        )
        return joined(lsel, rsel, null_equal, "inner").unionByName(left_only).unionByName(right_only)
    return joined(lsel, rsel, safe=null_equal)


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner", null_equal: bool = True) -> DataFrame:
    """Join on every shared column name (``inner_join(l, r)`` without ``by``)."""
    keys = shared_keys(left, right, pattern=None)
    if not keys:
        raise ValueError("natural_join: the frames share no column name")
    return join_na(left, right, keys, how=how, null_equal=null_equal)


def join_on(left: DataFrame, right: DataFrame, by: Mapping[str, str], how: str = "inner",
            suffix: tuple[str, str] = ("_x", "_y"), null_equal: bool = True) -> DataFrame:
    """``by={left_name: right_name}``; the left name survives."""
    return join_na(left, right, list(by.keys()), how=how, right_keys=list(by.values()), suffix=suffix,
                   null_equal=null_equal)


def full_join_na(left: DataFrame, right: DataFrame, by: Sequence[str] | None = None, pattern: str | None = "id",
                 suffix: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Full outer join on ``by`` (or on the shared names matching ``pattern``)."""
    keys = list(by) if by is not None else shared_keys(left, right, pattern=pattern)
    if not keys:
        raise ValueError("full_join_na: no key columns")
    return join_na(left, right, keys, how="full", suffix=suffix)


def join_all_na(tables: Mapping[str, DataFrame], by: Sequence[str] | None = None, how: str = "full",
                pattern: str | None = "id", unique: Sequence[str] = (), cell_rows: int = CELL_ROWS) -> DataFrame:
    """N-way join of a catalogue on the same ``by`` keys (or on the names that all tables share and that match ``pattern``).

    Suffix policy: a non-key column that appears in more than one table (names compared as the session
    does) is renamed ``{column}_{table}`` in every table that has it, so no name depends on the fold order. Keys of
    different types are brought to their common type, text if one of them is text.

    ``full``, ``inner`` and ``left`` joins move every row once, whatever the number of tables (:func:`_join_cells`); no input is
    written. Tables named in ``unique`` hold each key once, which is checked on the way (a repeated key raises); the others are
    first searched for hot keys in a job of their own. The other kinds fold ``join_na`` left to right.
    """
    names = list(tables)
    if not names:
        raise ValueError("join_all_na: no tables")
    by = list(by) if by is not None else shared_keys(*tables.values(), pattern=pattern)
    if not by:
        raise ValueError("join_all_na: the tables share no key")
    norm = _name_norm(tables[names[0]])
    keys = {norm(k): k for k in by}
    seen = Counter(norm(x) for df in tables.values() for x in df.columns if norm(x) not in keys)
    types = {}
    for k in by:
        own = [next(f.dataType for f in df.schema.fields if norm(f.name) == norm(k)) for df in tables.values()]
        if any(t != own[0] for t in own):
            if any(isinstance(t, StringType) for t in own):
                types[norm(k)] = StringType()
            else:
                one_column = [df.select(c(k).alias("k")) for df in tables.values()]
                types[norm(k)] = reduce(DataFrame.unionByName, one_column).schema["k"].dataType
    shaped = []
    for name, df in tables.items():
        cols = []
        for x in df.columns:
            if norm(x) in keys:
                col = c(x).cast(types[norm(x)]) if norm(x) in types else c(x)
                cols.append(col.alias(keys[norm(x)]))
            else:
                cols.append(c(x).alias(f"{x}_{name}" if seen[norm(x)] > 1 else x))
        shaped.append(df.select(*cols))
    if how in ("full", "inner", "left") and len(shaped) > 1:
        return _join_cells(shaped, by, how, cell_rows, [x in unique for x in names])
    return reduce(lambda a, b: join_na(a, b, by, how=how), shaped)


def _hot_keys(tables: Sequence[DataFrame], by: Sequence[str], cell_rows: int, single: Sequence[bool]) -> DataFrame | None:
    """The keys (``__k0``, ...) of which a table holds more than ``cell_rows`` rows, and the cuts of each table (``__s0``, ...).

    One job over the key columns, combined before the shuffle. No more than ``HOT_LISTED`` keys come to the driver; if there
    are more, the counts stay a table of the plan. None if there are no such keys. Tables with ``single`` rows are not read.
    """
    keys = [f"__k{i}" for i in range(len(by))]
    parts = [df.select(*[c(k).alias(x) for k, x in zip(by, keys)], F.lit(i).alias("__t")) for i, df in enumerate(tables) if not single[i]]
    if not parts:
        return None
    cuts = [F.ceil(F.count_if(F.col("__t") == i) / cell_rows) for i in range(len(tables))]
    each = reduce(DataFrame.unionAll, parts).groupBy(*keys)
    hot = each.agg(*[F.greatest(F.lit(1), x).cast("long").alias(f"__s{i}") for i, x in enumerate(cuts)])
    hot = hot.where(F.greatest(*[F.col(f"__s{i}") for i in range(len(tables))]) > 1)
    listed = hot.limit(HOT_LISTED + 1).collect()
    if not listed:
        return None
    if len(listed) > HOT_LISTED:
        return hot
    return F.broadcast(tables[0].sparkSession.createDataFrame(listed, hot.schema))


def _join_cells(tables: Sequence[DataFrame], by: Sequence[str], how: str, cell_rows: int, single: Sequence[bool]) -> DataFrame:
    """N-way join in one exchange: rows tagged by table, gathered by key, and each group expanded by table.

    A key with more than ``cell_rows`` rows in a table is dealt over a grid: table ``i`` is cut into ``s_i`` parts by a hash of
    the row, and a row of part ``j`` goes to all cells whose ``i``-th coordinate is ``j``. Every combination of rows
    meets in exactly one cell, and no cell holds more than about ``cell_rows`` rows of a table (rows that are equal in all
    columns share a part). Where a table lacks the key, its columns are NULL (``full``; ``left`` but for the
    first table), or the key is left out.
    """
    n, keys = len(tables), [f"__k{i}" for i in range(len(by))]
    values = [[x for x in df.columns if x not in by] for df in tables]
    packed = []
    for i, df in enumerate(tables):
        fields = [c(x).alias(f"v{j}") for j, x in enumerate(values[i])] or [F.lit(True).alias("v0")]
        packed.append(df.select(*[c(k).alias(x) for k, x in zip(by, keys)], F.struct(*fields).alias("__v")))
    kinds = [df.schema["__v"].dataType for df in packed]
    tagged = reduce(DataFrame.unionAll, [
        df.select(*keys, F.lit(i).alias("__t"), *[F.col("__v") if j == i else F.lit(None).cast(kinds[j]).alias(f"__v{j}") for j in range(n)])
        .toDF(*keys, "__t", *[f"__v{j}" for j in range(n)])
        for i, df in enumerate(packed)
    ])
    cells, cuts = [], [F.lit(1)] * n
    hot = _hot_keys(tables, by, cell_rows, single)
    if hot is not None:
        hot = hot.toDF(*[f"__h{x}" for x in keys], *[f"__s{i}" for i in range(n)])
        same = reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(f"__h{x}")) for x in keys])
        tagged = tagged.join(hot, same, "left").fillna(1, [f"__s{i}" for i in range(n)])
        row = F.xxhash64(*[f"__v{i}" for i in range(n)])
        cuts = [F.col(f"__s{i}") for i in range(n)]
        for i, cut in enumerate(cuts):
            own = F.when(F.col("__t") == i, F.array(F.pmod(row, cut))).otherwise(F.sequence(F.lit(0).cast("long"), cut - 1))
            tagged = tagged.withColumn(f"__c{i}", F.explode(own))
            cells += [f"__c{i}", f"__s{i}"]
    out = tagged.groupBy(*keys, *cells).agg(*[F.collect_list(f"__v{i}").alias(f"__l{i}") for i in range(n)])
    for i, cut in enumerate(cuts):
        rows = F.col(f"__l{i}")
        if single[i]:
            twice = F.concat(F.lit(f"join_all_na: table {i} is not unique on {list(by)}: "), F.to_json(F.struct(*keys)))
            one = F.when(F.size(rows) > 1, F.raise_error(twice).cast(kinds[i])).otherwise(F.get(rows, F.lit(0)))
            out = out.withColumn(f"__x{i}", one).drop(f"__l{i}")
            if how == "inner" or (how == "left" and i == 0):
                out = out.where(F.col(f"__x{i}").isNotNull())
            continue
        if how == "full" or (how == "left" and i > 0):
            # a table that is cut has the key, so an empty part of it adds nothing
            rows = F.when((F.size(rows) == 0) & (cut == 1), F.array(F.lit(None).cast(kinds[i]))).otherwise(rows)
        out = out.withColumn(f"__x{i}", F.explode(rows)).drop(f"__l{i}")
    cols = {k: c(x) for k, x in zip(by, keys)}
    picked = [cols.get(x, F.col(f"__x0.v{values[0].index(x)}") if x in values[0] else None).alias(x) for x in tables[0].columns]
    for i in range(1, n):
        picked += [F.col(f"__x{i}.v{j}").alias(x) for j, x in enumerate(values[i])]
    return out.select(*picked)


# ----------------------------------------------------------------------------- membership

def _key(df: DataFrame, on: str | Column, derive: Callable[[Column], Column] | None) -> Column:
    col = c(on) if isinstance(on, str) else on
    return derive(col) if derive else col


def restrict_to(df: DataFrame, ids: DataFrame, on: str | Column, ids_on: str | None = None, keep: bool = True,
                derive: Callable[[Column], Column] | None = None,
                derive_ids: Callable[[Column], Column] | None = None, null_equal: bool = True) -> DataFrame:
    """Semi (``keep=True``) or anti join of ``df`` against an id set.

    ``derive`` builds the key from ``on`` (e.g. drop a vial letter); ``derive_ids``
    builds it on the id side (defaults to ``derive``). With ``null_equal`` a NULL
    key is "in" the set only when the set holds a NULL, so an anti join keeps NULL
    rows unless the set has a NULL (R's ``!x %in% y``).
    """
    ids_on = ids_on or ids.columns[0]
    lk = _key(df, on, derive)
    rk = _key(ids, ids_on, derive_ids or derive)
    left = df.withColumn("__mk", lk)
    right = ids.select(rk.alias("__ik")).distinct()
    cond = c("__mk").eqNullSafe(c("__ik")) if null_equal else c("__mk") == c("__ik")
    return left.join(right, cond, "left_semi" if keep else "left_anti").drop("__mk")


def flag_membership(df: DataFrame, ids: DataFrame, on: str | Column, out: str, ids_on: str | None = None,
                    derive: Callable[[Column], Column] | None = None,
                    derive_ids: Callable[[Column], Column] | None = None,
                    true_value=True, false_value=False, null_equal: bool = True) -> DataFrame:
    """Add ``out`` = whether the (derived) key is in the id set (never NULL).

    A left join to the *distinct* keys of the id side, so rows never multiply.
    """
    ids_on = ids_on or ids.columns[0]
    keys = ids.select(_key(ids, ids_on, derive_ids or derive).alias("__fk")).distinct().withColumn("__hit", F.lit(True))
    left = df.withColumn("__mk", _key(df, on, derive))
    cond = c("__mk").eqNullSafe(c("__fk")) if null_equal else c("__mk") == c("__fk")
    joined = left.join(keys, cond, "left")
    flag = F.when(c("__hit"), F.lit(true_value)).otherwise(F.lit(false_value))
    return joined.withColumn(out, flag).drop("__mk", "__fk", "__hit")


#: Stands for anything that is not a required literal while a pattern is taken apart; in no way part of a literal.
_GAP = "\u0001"
_LITERAL = 3  # code points of the shortest literals that are indexed
#: Lengths of the pieces that are indexed; a literal is cut at the largest that it reaches, since longer pieces are rarer.
_LENGTHS = (_LITERAL, 5, 7)
#: Up to so many patterns, their pieces are broadcast; with more of them, pieces of patterns and values meet by a shuffle.
FEW_PATTERNS = 10_000
#: Patterns without a required literal that are sent to every task; more of them are dealt into blocks.
LOOSE_PATTERNS = 10_000


def required_literals(pattern: Column, lengths: Sequence[int] = (_LITERAL,)) -> Column:
    """Literals that any match of a Java regex holds, as their pieces of three code points; empty if none is certain.

    With more ``lengths`` (ascending), a literal is given as its pieces of the largest length that it reaches.

    Escapes, classes, groups, wildcards, anchors and whatever a quantifier makes optional are cut out; what is left between
    the cuts must occur as it stands. Flags, alternatives, back references and the like are not taken apart.
    """
    unsure = pattern.contains("(?") | F.regexp_like(pattern, F.lit(r"\\[pPxucNkQE0-9]|\[\^?\]|\[[^\]]*\["))
    s = pattern
    for cut in (r"(?s)\\.", r"\[[^\]]*\]", *[r"\([^()]*\)(?:[?*+]|\{[^}]*\})?[?+]?"] * 4, r"(?s).(?:\?|\*|\{[^}]*\})[?+]?", r"\+[?+]?", r"[\^$.{}]"):
        s = F.regexp_replace(s, cut, _GAP)
    unsure = unsure | F.regexp_like(s, F.lit(r"[()|\[\]]")) | pattern.contains(_GAP)

    def longest(text: Column) -> Column:
        out = _pieces(text, lengths[0])
        for n in lengths[1:]:
            out = F.when(F.length(text) >= n, _pieces(text, n)).otherwise(out)
        return out

    pieces = F.transform(F.split(s, _GAP), longest)
    return F.when(unsure, F.array().cast("array<string>")).otherwise(F.array_distinct(F.flatten(pieces)))


def _pieces(text: Column, size: int = _LITERAL) -> Column:
    """All stretches of ``size`` code points."""
    n = F.length(text) - (size - 1)
    every = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(text, i, size))
    return F.when(n > 0, every).otherwise(F.array().cast("array<string>"))


def _match_regexes(values: DataFrame, pats: DataFrame, blocks: int) -> DataFrame:
    """The values ``__x`` that hold a match of any pattern ``__p``.

    Up to the last two joins only numbers move: the hashes of pieces and of values, and the row numbers of written
    patterns. Hashes that clash lead to more candidates, which are verified. The sizes that the planner guesses for exploded
    pieces are far too small, so every join of tables that grow is told to be a merge join.
    """
    # a plain alternative is a pattern of its own
    parts = F.when(F.regexp_like("__p", F.lit(r"[(\[\\]")), F.array("__p")).otherwise(F.split("__p", r"\|"))
    pats = pats.select(F.explode(parts).alias("__p")).distinct().withColumn("__g", required_literals(F.col("__p"), _LENGTHS))
    pats = pats.select(F.monotonically_increasing_id().alias("__i"), "__p", F.transform("__g", lambda g: F.xxhash64(g)).alias("__g"))
    pats = materialize(pats)
    few = pats.count() <= FEW_PATTERNS

    # index: the pieces that patterns ask for, and the values that hold them
    asked = pats.select("__i", F.explode("__g").alias("__g"))
    numbered = values.select(F.xxhash64("__x").alias("__v"), "__x")
    every = F.array_distinct(F.concat(*[_pieces(F.col("__x"), n) for n in _LENGTHS]))
    held = numbered.select("__v", F.explode(every).alias("__g")).select("__v", F.xxhash64("__g").alias("__g"))
    if few:
        held = held.join(F.broadcast(asked.select("__g").distinct()), "__g", "left_semi")
    found = held.groupBy("__g").agg(F.count(F.lit(1)).alias("__n"))
    # a pattern with a piece that no value holds matches none; of the others the rarest piece leads to the candidates
    rated = asked.join(found.hint("merge"), "__g", "left").groupBy("__i")
    rated = rated.agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__g").alias("g"))).alias("r"))
    rarest = materialize(rated.where("r.n > 0").select("__i", F.col("r.g").alias("__g")))
    met = held.join(F.broadcast(rarest) if few else rarest.hint("merge"), "__g").select("__v", "__i")
    met = met.join(pats.select("__i", "__p").hint("merge"), "__i").select("__v", "__p")
    matched = met.join(numbered.hint("merge"), "__v").where(F.regexp_like("__x", F.col("__p"))).select("__x")

    loose = pats.where(F.size("__g") == 0).select("__p")
    listed = loose.limit(LOOSE_PATTERNS + 1).collect()
    if listed and len(listed) <= LOOSE_PATTERNS:
        bounded = F.broadcast(loose.sparkSession.createDataFrame(listed, loose.schema))
        matched = matched.unionByName(values.join(bounded, F.regexp_like("__x", F.col("__p")), "left_semi"))
    elif listed:
        dealt = loose.select("__p", F.pmod(F.xxhash64("__p"), F.lit(blocks)).alias("__pb"))
        each = values.select("__x", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("__xb"))
        hit = (F.col("__xb") == F.col("__pb")) & F.regexp_like(F.col("__x"), F.col("__p"))
        matched = matched.unionByName(each.join(dealt, hit, "left_semi").select("__x"))
    return matched.distinct()


def match_any(df: DataFrame, column: str, patterns: DataFrame, pattern_column: str | None = None,
              mode: str = "regex", keep: bool = True, blocks: int = 32) -> DataFrame:
    """Keep (or drop) rows whose ``column`` matches any pattern of a pattern table.

    ``mode='prefix'``: patterns are literal prefixes. Every value is cut at the lengths that occur among
    the patterns (a join with the table of lengths) and the cuts are semi joined: equi-joins only.
    ``mode='regex'``: Java regexes searched anywhere. Patterns are indexed by the rarest stretch of three, five or seven characters that
    each of them must contain; values meet their candidates by an equi-join and are verified, so a value is tested
    against few patterns however many there are. Patterns without such a stretch (counted; a small job of its own)
    are tested against every value: sent to all tasks, or beyond ``LOOSE_PATTERNS`` dealt into ``blocks`` by hash.

    Matching runs on the distinct values of ``column`` and the result is semi/anti joined back, so each row is kept at
    most once. NULL values never match and are dropped in both modes (a NULL match result filters the row out).
    An empty pattern table matches nothing. A pattern that is not a regex raises when a value is tested against it.
    """
    pattern_column = pattern_column or patterns.columns[0]
    pats = patterns.select(c(pattern_column).alias("__p")).filter(F.col("__p").isNotNull()).distinct()
    values = df.select(c(column).alias("__x")).filter(F.col("__x").isNotNull()).distinct()

    if mode == "prefix":
        lengths = pats.select(F.length("__p").alias("__n")).distinct()
        cuts = values.select("__x", F.explode(F.sequence(F.lit(0), F.length("__x"))).alias("__n")).join(lengths, "__n", "left_semi")
        cuts = cuts.select("__x", F.expr("substring(__x, 1, __n)").alias("__p"))
        matched = cuts.join(pats, "__p", "left_semi").select("__x").distinct()
    elif mode == "regex":
        matched = _match_regexes(values, pats, blocks)
    else:
        raise ValueError(f"match_any: unknown mode {mode!r}")

    base = df.filter(c(column).isNotNull())
    return base.join(matched, c(column) == F.col("__x"), "left_semi" if keep else "left_anti")
