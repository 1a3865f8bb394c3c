"""The pipeline's stages against their operators, and odd tables."""

import pickle

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from metaweave.llm import packing, stream_dedup, toxicity_crf
from metaweave.llm.common import saved, tokenizer_path

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    assert [name for name, _ in pipeline.STAGES] == ["quality classifier", "toxicity", "exact dedup", "SimHash near-dedup", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before = docs
    for _, stage in pipeline.STAGES[:-1]:
        after = saved(stage(spark, before, SF), "stage")
        assert after.columns == docs.columns and 0 < after.count() <= before.count()
        assert after.exceptAll(before).isEmpty()
        before = after
    assert before.count() == before.select("text").distinct().count()
    kept = before.join(labels, "doc_id")
    assert kept.where("toxic = 1 or quality = 0").count() <= 0.05 * kept.count()
    pieces = pipeline.packing(spark, before, SF)
    assert pieces.select("doc_id").distinct().count() == before.count()


def test_deduplicating_stages_keep_one_row_each(spark, docs_file):
    exact = saved(pipeline.exact_duplicates(spark, docs_file, SF), "stage")
    assert exact.columns == docs_file.columns
    assert exact.where("doc_id in (1, 2, 4)").select("doc_id").collect() == [(4,)]
    assert exact.where("doc_id in (5, 6, 7, 15, 16)").orderBy("doc_id").select("doc_id").collect() == [(6,), (7,), (16,)]
    near = saved(pipeline.near_duplicates(spark, exact, SF), "stage")
    assert near.columns == docs_file.columns and near.where("doc_id is null").count() == 1
    assert near.where("doc_id in (6, 7)").count() == 1 and near.where("doc_id in (8, 9)").count() == 1


def test_empty_table(spark, no_docs):
    docs = no_docs
    for _, stage in pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), "stage")
        assert docs.isEmpty()


def test_repeated_rows_leave_one(spark):
    rows = spark.createDataFrame([(1, "equal words"), (1, "equal words"), (None, "no id"), (None, "no id")], "doc_id long, text string")
    exact = saved(pipeline.exact_duplicates(spark, rows, SF), "stage")
    assert exact.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty() and exact.count() == 2
    twice = spark.createDataFrame([(1, "equal words here"), (1, "equal  words here"), (None, "no id"), (None, "NO id")], "doc_id long, text string")
    near = saved(pipeline.near_duplicates(spark, twice, SF), "stage")
    assert near.count() == 2


def test_columns_with_the_stages_own_names_pass(spark):
    """Further columns stay as they are, also those named like the columns that a stage adds for itself."""
    small = "/root/testdata/sf0.001"
    plain = spark.read.parquet(f"{small}/documents.parquet")
    extra = ["__file", "__POS", "__score", "file", "pos", "score", "component", "kept"]
    docs = saved(plain.withColumns({x: F.concat(F.lit(x), F.col("doc_id").cast("string")) for x in extra}), "docs")
    for name, stage in pipeline.STAGES[:-1]:
        after, bare = (saved(stage(spark, x, small), "stage") for x in (docs, plain))
        assert after.columns == docs.columns, name
        assert after.select(plain.columns).exceptAll(bare).isEmpty() and after.count() == bare.count() > 0
        assert after.where(" or ".join(f"`{x}` != concat('{x}', cast(doc_id as string))" for x in extra)).isEmpty()
        docs, plain = after, bare
    packed = pipeline.packing(spark, docs, small)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_workers_of_the_stages_get_few_texts_at_once(spark):
    """Executors and workers hold a batch of whole texts several times over; a smaller setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.range(5000).selectExpr("id AS doc_id", "concat('text ', id) AS text").coalesce(1)
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, 10_000)
        packed = pipeline.packing(spark, docs, "")
        assert packed.agg(F.countDistinct("doc_id")).first()[0] == 5000
        sizes = docs.mapInPandas(lambda batches: (b.assign(n=len(b))[["n"]][:1] for b in batches), "n long")
        assert sizes.agg(F.max("n"), F.sum("n")).first()[:] == (2048, 5000)
        spark.conf.set(name, 100)
        pipeline.packing(spark, docs, "")
        assert spark.conf.get(name) == "100"
    finally:
        spark.conf.set(name, before)


def test_a_small_memo_gives_the_same_pieces_and_scores(spark):
    """Stages that share memory remember fewer words; a full memo keeps those that came first and changes no result."""
    docs = spark.range(600).selectExpr("id AS doc_id", "concat('Common words, rare', id, ' und Öl', id % 7, '!') AS text").coalesce(1)
    want, got = (packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), memo=x).collect() for x in (None, (100, 20)))
    assert got == want
    rng = np.random.default_rng(5)
    model = toxicity_crf.Field(rng.normal(size=toxicity_crf.BUCKETS), np.zeros((2, 2)))
    small = pickle.loads(pickle.dumps(toxicity_crf.Field(model.w, model.trans, entries=40)))
    texts = [[b"first", b"words", *(f"rare{i}x{k}".encode() for k in range(30))] for i in range(10)]
    for x in texts * 2:
        assert np.array_equal(small.emissions([x]), model.emissions([x]))
        assert len(small.memo) <= 40 + len(x) and set(list(small.memo)[:20]) <= set(texts[0]) and len(small.table[0]) == len(small.memo)


def test_stores_of_the_stream_close_with_their_tasks(spark):
    """An executor that keeps the stores of all partitions open holds the buffers of all of them."""
    name = "spark.sql.streaming.stateStore.unloadOnCommit"
    before = spark.conf.get(name)
    with stream_dedup._rocksdb(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == before
