"""The corpus pipeline: five stages that each call one operator, applied to ``documents`` in order.

Every stage takes what its predecessor kept, written as Parquet and read back, and returns whole rows
of ``documents`` (the last one returns the packed pieces). NULL texts count as empty in every
stage; repeated rows are rows of their own until the deduplications keep one of them; an empty table stays
empty; further columns of ``documents`` are passed on untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaweave.llm import quality_fm, toxicity_crf
from metaweave.llm.common import importable, join_narrow, saved, small_batches, table, tokenizer_path, with_place
from metaweave.llm.packing import pack_documents
from metaweave.llm.simhash import simhash_groups
from metaweave.llm.stream_dedup import exact_dedup


#: Words that a Python worker of a stage remembers. The stages share their executors' memory, so they remember fewer than the
#: operators do by themselves; of the full memo of packing, the words that came first stay.
MEMO_WORDS = 150_000
MEMO_KEPT = 100_000


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names for columns that a stage adds for itself and drops again, none of which ``docs`` has."""
    taken = {x.lower() for x in docs.columns}
    mark = "__"
    while any(mark + x in taken for x in names):
        mark += "_"
    return [mark + x for x in names]


@importable
@small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"))
    (own,) = _free(docs, "score")
    scored = docs.withColumn(own, quality_fm.score(F.col("text"), model, spark))
    return scored.where(F.col(own) >= quality_fm.THRESHOLD).drop(own)


@importable
@small_batches
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    model = toxicity_crf.train(docs, table(spark, sf_dir, "labels"))
    model.entries = MEMO_WORDS
    (own,) = _free(docs, "score")
    scored = docs.withColumn(own, toxicity_crf.score(F.col("text"), model, spark))
    return scored.where(F.col(own) < toxicity_crf.THRESHOLD).drop(own)


def _without(docs: DataFrame, dropped: DataFrame, place: list[str]) -> DataFrame:
    """The rows that are not listed by their place."""
    return join_narrow(docs, saved(dropped.select(*place), "dropped"), place, "left_anti").drop(*place)


@importable
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest identifier."""
    file, pos = place = _free(docs, "file", "pos")
    rows = with_place(docs, file, pos)
    groups = exact_dedup(rows, place=(file, pos))
    return _without(rows, groups.where("not kept").select(F.col("file").alias(file), F.col("pos").alias(pos)), place)


@importable
@small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates, the document with the smallest identifier."""
    place = _free(docs, "file", "pos")
    rows = with_place(docs, *place)
    groups = saved(simhash_groups(rows, carry=place), "near-groups")
    # of rows that bear the group's identifier (none if no row has one), the first stays
    bearers = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = bearers.groupBy("component").agg(F.min(F.struct(*place)).alias("first"))
    stay = stay.select("first.*")
    return _without(rows, groups.join(stay, place, "left_anti"), place)


@importable
@small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, in sequences of 4096 tokens."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), memo=(MEMO_WORDS, MEMO_KEPT))


STAGES = [
    ("quality classifier", quality),
    ("toxicity", toxicity),
    ("exact dedup", exact_duplicates),
    ("SimHash near-dedup", near_duplicates),
    ("packing", packing),
]

#: Trained models decide in the first stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read back, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return docs
