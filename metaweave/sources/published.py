"""Sets of tables that are published together, or not at all.

Tables of a set are written to a folder of their own, rows and checks are counted by that same write, and one
manifest file names the folders. Readers go by the manifest alone: until its file is in place, and whenever a write or a
check fails, they see the set that was published before. Nothing that a manifest names is ever overwritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from metaweave.sources.writers import _typed

MANIFEST = """version long, name string, path string, rows long,
    checks array<struct<name:string,expected:long,actual:long>>"""


class Check(NamedTuple):
    """Two aggregates over a table's rows that must be equal: ``Check('parts', count(1), count_if(a) + count_if(b))``."""

    name: str
    expected: Column
    actual: Column


class CheckFailed(ValueError):
    """A check did not hold; the set was not published."""


def manifest(spark: SparkSession, place: str) -> DataFrame:
    """``(version, name, path, rows, checks)`` of every table of every published set; no rows if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{place.rstrip('/')}/manifest")
    if not path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path.toString())


def latest_version(spark: SparkSession, place: str) -> int:
    """The version of the set published last, 0 if there is none."""
    return manifest(spark, place).agg(F.max("version")).first()[0] or 0


def publish(tables: Mapping[str, DataFrame], place: str, checks: Mapping[str, Sequence[Check]] | None = None) -> int:
    """Write a set of tables and publish it as the next version, which is returned.

    ``checks`` lists, by table, what must hold for its rows. Counts and checks are observed on the rows as they are
    written, so the data is evaluated once; an aggregate that is NULL (over no rows) counts as 0. If a check fails,
    ``CheckFailed`` names the table and figures. Tables may be made from the set published before, since its files stay
    as they are. One publisher at a time: two that end together would claim the same version, so the later one raises.
    """
    if not tables:
        raise ValueError("publish: no tables")
    unknown = set(checks or {}) - set(tables)
    if unknown:
        raise KeyError(f"publish: checks of tables that are not in the set: {sorted(unknown)}")
    spark = next(iter(tables.values())).sparkSession
    version = latest_version(spark, place) + 1
    folder = f"{place.rstrip('/')}/data/{version:06d}-{uuid.uuid4().hex}"
    entries, failed = [], []
    for i, (name, df) in enumerate(tables.items()):
        asked = list((checks or {}).get(name, ()))
        seen = Observation()
        aggs = [F.count(F.lit(1)).alias("rows")]
        for k, check in enumerate(asked):
            aggs += [check.expected.cast("long").alias(f"e{k}"), check.actual.cast("long").alias(f"a{k}")]
        path = f"{folder}/{i}"
        _typed(df).observe(seen, *aggs).write.mode("errorifexists").parquet(path)
        got = seen.get
        found = [(check.name, got.get(f"e{k}") or 0, got.get(f"a{k}") or 0) for k, check in enumerate(asked)]
        failed += [(name, *x) for x in found if x[1] != x[2]]
        entries.append((version, name, path, got.get("rows") or 0, found))
    if failed:
        told = "; ".join(f"{name}: {check} expected {e}, found {a}" for name, check, e, a in failed)
        raise CheckFailed(f"not published: {told}")
    if latest_version(spark, place) >= version:
        raise RuntimeError(f"publish: version {version} of {place} was published by someone else meanwhile")
    # one row a table, written as one file: its rename by the job's commit is what publishes the set
    spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{place.rstrip('/')}/manifest")
    return version


def read_published(spark: SparkSession, place: str, name: str, version: int | None = None) -> DataFrame:
    """A table of the set published last, or of an earlier ``version``."""
    version = latest_version(spark, place) if version is None else version
    found = manifest(spark, place).where((F.col("version") == version) & (F.col("name") == name)).select("path").collect()
    if not found:
        raise KeyError(f"no table {name!r} in version {version} of {place}")
    return spark.read.parquet(found[0]["path"])


def read_all_versions(spark: SparkSession, place: str, name: str) -> DataFrame | None:
    """The rows of a table from all published versions together, for tables published in increments; None if there are none."""
    found = manifest(spark, place).where(F.col("name") == name).select("path").orderBy("version").collect()
    return spark.read.parquet(*[x["path"] for x in found]) if found else None
