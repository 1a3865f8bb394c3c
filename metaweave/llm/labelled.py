"""A bounded, deterministic sample of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold

FOLDS = 5  # rows whose crc32(doc_id) is divisible by it are held out


def held_out(doc_id: str = "doc_id", folds: int = FOLDS):
    return fold(F.col(doc_id), folds) == 0


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int, by_class: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id``, whole ``text`` and ``label`` (0 or 1) of at most ``max_rows`` labelled rows, never held-out ones.

    Rows are taken in the order of a hash of the identifier; with ``by_class``, at most
    half of ``max_rows`` from each class. NULL labels and identifiers are left out; of
    several labels of one identifier the largest counts.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id))
        .groupBy(F.col(doc_id).alias("key")).agg(F.max((F.col(label) > 0).cast("int")).alias("label"))
    )
    order = [F.xxhash64("key"), F.col("key")]
    if by_class:
        picked = known.where("label = 1").orderBy(*order).limit(max_rows // 2)
        picked = picked.unionByName(known.where("label = 0").orderBy(*order).limit(max_rows - max_rows // 2))
    else:
        picked = known.orderBy(*order).limit(max_rows)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # the picked rows are bounded by max_rows
    return own.join(F.broadcast(picked), F.col("doc_id") == F.col("key")).select("doc_id", "text", "label")
