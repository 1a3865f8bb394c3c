"""One query for each corpus operator, with its production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality_fm, sql, toxicity_crf
from .byte_bpe import round_trip_digests
from .common import importable, split_pattern, table, tokenizer_path
from .fill_middle import fill_in_middle, restored
from .labelled import held_out
from .line_frequency import line_frequency
from .maxent_lm import held_out_fold, lm_scores
from .minmax_dedup import near_duplicates
from .packing import pack_documents
from .page_template import extract
from .simhash import simhash_groups
from .spelling import spelling_variants
from .stream_dedup import exact_dedup
from .warc_zip import round_trip


def op2_stream_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("file", "pos")


def op1_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_scores(docs, ~held_out_fold(), carry={"held_out": held_out_fold()})


def _classified(spark: SparkSession, sf_dir: str, operator) -> DataFrame:
    """Fit on labelled rows that are not held out, score every whole text."""
    docs = table(spark, sf_dir, "documents")
    model = operator.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), operator.score(F.col("text"), model, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= operator.THRESHOLD).cast("int"))


def op3_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, toxicity_crf)


def op4_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, quality_fm)


def op5_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer_path("byte_bpe_multi_50k.tiktoken"), split_pattern()
    docs = table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", round_trip_digests(F.col("text"), path, pattern).alias("x"))
    return coded.select("doc_id", "x.n_tokens", "x.ids_sha256", "x.decoded_sha256")


def op7_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op8_page_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op9_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op10_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency(table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    back = F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), back)


def op12_spelling_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


_ALL = [
    op1_maxent_lm,
    op2_stream_exact_dedup,
    op3_crf_toxicity,
    op4_fm_quality,
    op5_cost_balanced_packing,
    op6_byte_bpe,
    op7_zip_warc,
    op8_page_template,
    op9_simhash_multi_index,
    op10_line_frequency,
    op11_fill_middle,
    op12_spelling_gram,
    op13_minmax_dedup,
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: importable(f) for f in _ALL}

ORACLE_SQL: dict[str, str] = {
    "op2_stream_exact_dedup": sql.EXACT_DEDUP,
    "op7_zip_warc": sql.WARC_RECORDS,
    "op10_line_frequency": sql.LINE_FREQUENCY,
    "op11_fill_middle": sql.FILL_MIDDLE,
    "op12_spelling_gram": sql.SPELLING,
    "op13_minmax_dedup": sql.NEAR_DUPLICATES,
}
