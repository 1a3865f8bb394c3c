"""Helpers shared by the corpus operators."""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metaweave.session import ensure_checkpoint_dir

#: The white space that separates words (tab to carriage return, and space).
BLANKS = "\t\n\x0b\x0c\r "


def importable(fn: Callable) -> Callable:
    """For functions of ``(spark, ...)``: Python workers that share the driver's files can import this package.

    Where they share none, ship it as usual (``--py-files``).
    """

    @functools.wraps(fn)
    def run(spark: SparkSession, *args):
        env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
        paths = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
        if root not in paths:
            env["PYTHONPATH"] = os.pathsep.join([*paths, root])
        return fn(spark, *args)

    return run


#: Rows of an Arrow batch of whole texts (a multiple of the 256 texts that operators take at once).
BATCH_ROWS = 2048
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(fn: Callable) -> Callable:
    """For stages of ``(spark, ...)`` whose Python workers get whole texts: batches of at most :data:`BATCH_ROWS` rows.

    10,000 texts at once, Spark's default, are held several times by the executor and by each worker. The session keeps the
    smaller number, since stages are written by their callers.
    """

    @functools.wraps(fn)
    def run(spark: SparkSession, *args):
        if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
            spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
        return fn(spark, *args)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the checkpoint folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back (cuts the lineage)."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and nothing else; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo ``k``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % k


def words(text: Column) -> Column:
    """The words of a text: runs of characters outside :data:`BLANKS`. NULL has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), BLANKS[:-1], " " * (len(BLANKS) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def with_place(df: DataFrame, file: str = "file", pos: str = "pos") -> DataFrame:
    """Add two columns which tell any two rows apart: the file and row index of a file scan.

    Any other input is first written to the shared folder, and read back from there.
    """
    place = {file: F.col("_metadata.file_path"), pos: F.col("_metadata.row_index")}
    try:
        return df.withColumns(place)
    except AnalysisException:
        return saved(df, "placed").withColumns(place)


#: Up to so many rows of a few narrow columns are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 50_000


def join_narrow(df: DataFrame, narrow: DataFrame, on, how: str, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Join a narrow, written table to a wide one; the wide one is not shuffled while the other is counted small."""
    return df.join(F.broadcast(narrow) if narrow.count() <= bound else narrow, on, how)
