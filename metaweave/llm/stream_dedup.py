"""Exact deduplication with a stateful stream.

Each document is landed as a narrow row: digest, stable identifier, content locator
(file and row). A Structured Streaming aggregation keyed by digest reads the landed
rows and keeps, in a RocksDB state store without expiry, the identifier and locator of
the row that stays and the number of rows seen. Its checkpoint lies in the
shared folder, so state survives lost executors and later landings continue from it.
Rows of one digest are combined on the map side, so a text that a third of the rows
hold reaches its state as one row per task.

A digest seen more than once is a hit. The texts of hits are fetched and compared
byte for byte with the text at the stored locator; rows that share a digest but not the bytes
form groups of their own.

Defined results: NULL counts as empty text, and empty texts equal one another. Of equal
rows with equal identifiers the one with the largest locator stays, so exactly one does.
A NULL identifier is smaller than all others. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, saved, shared_folder, with_place

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BROADCAST_DIGESTS = 100_000  # up to so many hit digests (32 bytes each) are broadcast; more are joined by a shuffle


#: Session settings while the stream runs: the disk-backed provider, without reserving disk ahead for each of its many small stores; a store
#: is closed with its task, since an executor that keeps the stores of all its partitions open holds the buffers of all of them.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


@contextmanager
def _rocksdb(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for k, v in STATE_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def located(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", place: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id``, ``file`` and ``pos`` (the content locator) and the normalised ``text``.

    ``place`` names two columns that tell rows apart, if the input has them; else rows are located
    by file and row index.
    """
    own = [F.col(doc_id).alias("doc_id"), F.col(text).alias("text")]
    if place:
        rows = docs.select(*own, F.col(place[0]).alias("file"), F.col(place[1]).alias("pos"))
    else:
        rows = with_place(docs).select(*own, "file", "pos")
    return rows.withColumn("text", lower_ascii(F.col("text")))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def land(rows: DataFrame, folder: str) -> None:
    """Append digest, identifier and locator of each row to the stream's source folder."""
    rows.select("doc_id", "file", "pos", digest(F.col("text")).alias("digest")).write.mode("append").parquet(folder)


def run_stream(spark: SparkSession, folder: str, state: str) -> DataFrame:
    """Take in all landed rows that ``state`` has not seen; returns the state: one row per digest."""
    schema = spark.read.parquet(folder).schema
    seen = spark.readStream.schema(schema).parquet(folder)
    keyed = seen.groupBy("digest").agg(
        F.max(F.struct("doc_id", "file", "pos")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    with _rocksdb(spark):
        query = (
            keyed.writeStream.outputMode("update").format("noop")
            .option("checkpointLocation", state).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        held = spark.read.format("statestore").load(state)
    value = [f.name for f in held.schema["value"].dataType.fields]
    return held.select(
        F.col("key.digest").alias("digest"),
        F.col(f"value.`{value[0]}`").alias("keep"),
        F.col(f"value.`{value[1]}`").alias("group_size"),
    )


def hit_texts(rows: DataFrame, hits: DataFrame, broadcast_digests: int = BROADCAST_DIGESTS) -> DataFrame:
    """The texts whose digest was hit, with their locators."""
    keys = hits.select("digest")
    if keys.count() <= broadcast_digests:
        keys = F.broadcast(keys)
    texts = rows.withColumn("digest", digest(F.col("text")))
    return texts.join(keys, "digest", "left_semi")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", place: tuple[str, str] | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and its locator."""
    spark = docs.sparkSession
    rows = located(docs, doc_id, text, place)
    folder = shared_folder(spark, "dedup-landed")
    land(rows, folder)
    state = saved(run_stream(spark, folder, shared_folder(spark, "dedup-state")), "dedup-groups")
    landed = spark.read.parquet(folder)

    hits = state.where("group_size > 1")
    texts = saved(hit_texts(rows, hits), "dedup-hits")
    first = texts.join(
        hits.select("digest", F.col("keep.file").alias("file"), F.col("keep.pos").alias("pos")), ["digest", "file", "pos"]
    ).select("digest", F.col("text").alias("kept_text"))
    odd = texts.join(first, "digest").where(F.col("text") != F.col("kept_text")).drop("kept_text")
    odd = saved(odd, "dedup-odd")

    out = landed.join(state, "digest")
    if not odd.isEmpty():
        out = _regroup(out, odd)
    return out.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        ((F.col("file") == F.col("keep.file")) & (F.col("pos") == F.col("keep.pos"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "file", "pos",
    )


def _regroup(out: DataFrame, odd: DataFrame) -> DataFrame:
    """Groups of their own for rows whose digest equals that of the kept row but whose bytes differ."""
    apart = odd.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "file", "pos")).alias("own_keep"), F.count(F.lit(1)).alias("own_size")
    )
    apart = odd.join(apart, ["digest", "text"]).select("file", "pos", "own_keep", "own_size")
    gone = odd.groupBy("digest").agg(F.count(F.lit(1)).alias("gone"))
    out = out.join(apart, ["file", "pos"], "left").join(gone, "digest", "left")
    size = F.coalesce("own_size", F.col("group_size") - F.coalesce("gone", F.lit(0)))
    return out.withColumn("group_size", size).withColumn("keep", F.coalesce("own_keep", "keep"))
