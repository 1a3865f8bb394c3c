"""A reader of JSON arrays that splits files, whatever their layout.

The file is cut behind every ``}`` and read by byte ranges, as any text is. Whether a cut lies inside a string and how deep it lies
depend on all that comes before it in its file, so each range first says what it does to that state from either start
(outside or inside of a string); running sums of one row a range give the state in which each begins. A cut piece
that begins and ends between two elements of the array is an element, and is parsed in its place. Only elements
with a ``}`` of their own inside (in a string, or nested objects) are put together from their pieces, by file and number.

No task sees more than a range of a file, or the pieces of one element. The text moves once, to be numbered within its
range, and is written once in the shared folder, so both passes see the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from metaweave.session import materialize

_RANGE = ["file", "start"]


def _count(text: Column, signs: str) -> Column:
    """How many of the characters a text has."""
    return F.length(F.regexp_replace(text, rf"[^{signs}]+", ""))


def _depth(text: Column, closes: Column) -> Column:
    """What a text without strings adds to the depth; ``closes`` says whether the cut behind it ends an object."""
    return _count(text, r"\[{") - _count(text, r"\]") - closes.cast("int")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of all ranges in order: whether each has an odd number of quotes, and what it and those before in its range do to
    the state, if the range starts outside (``0``) or inside (``1``) of a string."""
    raw = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"),
    )
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # an escape never straddles a cut: \} is no JSON
    outside = F.regexp_replace("plain", r'"[^"]*("|\z)', "")
    behind = F.regexp_replace(F.regexp_replace("plain", r'^[^"]*("|\z)', ""), r'"[^"]*("|\z)', "")
    odd = _count(F.col("plain"), '"') % 2
    told = raw.withColumn("plain", plain).select(
        "value", *_RANGE, "at", odd.alias("odd"), _depth(outside, odd == 0).alias("out_first"), _depth(behind, odd == 1).alias("in_first")
    )
    order = Window.partitionBy(*_RANGE).orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    within = F.sum("odd").over(so_far) - F.col("odd")
    told = told.withColumn("quoted", (within % 2).cast("int"))
    first, second = F.col("out_first"), F.col("in_first")
    told = told.withColumns({"add0": F.when(F.col("quoted") == 0, first).otherwise(second), "add1": F.when(F.col("quoted") == 0, second).otherwise(first)})
    told = told.withColumns({"sum0": F.sum("add0").over(so_far), "sum1": F.sum("add1").over(so_far)})
    return materialize(told.drop("out_first", "in_first"))


def _before(total: str, by_file: Window) -> Column:
    """The sum of the ranges before in the file."""
    return F.coalesce(F.sum(total).over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def read_json_array_ranges(spark: SparkSession, path: str, schema: StructType | str, mode: str = "FAILFAST") -> DataFrame:
    """One row for each object of the JSON arrays at ``path``: a file, or a folder of files with an array each; every range of a file is a task.

    ``schema`` names the fields to read; absent ones are NULL. ``mode`` is that of Spark's JSON parser: an object that does
    not fit raises, or is NULL with ``PERMISSIVE``. Elements that are no objects, and files that end within an element, raise.
    An empty file and an empty array have no rows. Rows come in no order.
    """
    pieces = _pieces(spark, path)
    by_file = Window.partitionBy("file").orderBy("start")  # one row a range
    ranges = pieces.groupBy(*_RANGE).agg(F.sum("odd").alias("odd"), F.sum("add0").alias("add0"), F.sum("add1").alias("add1"))
    ranges = ranges.withColumn("inside", (_before("odd", by_file) % 2).cast("int"))
    ranges = ranges.withColumn("adds", F.when(F.col("inside") == 0, F.col("add0")).otherwise(F.col("add1")))
    # behind the last } lies what closes the array, with no } of its own: a whole file adds up to -1
    total = F.sum("adds").over(Window.partitionBy("file"))
    cut = F.raise_error(F.concat(F.lit("JSON array is cut off: "), "file"))
    ranges = ranges.select(*_RANGE, "inside", F.when(total == -1, _before("adds", by_file)).otherwise(cut.cast("bigint")).alias("depth"))
    own = F.col("inside") == 0
    state = pieces.join(ranges, _RANGE).select(
        *_RANGE, "at", "value", (F.col("quoted") != F.col("inside")).alias("opens_in"),
        ((F.col("quoted") + F.col("odd") + F.col("inside")) % 2 == 1).alias("ends_in"),
        (F.col("depth") + F.when(own, F.col("sum0")).otherwise(F.col("sum1"))).alias("after"),
        F.when(own, F.col("add0")).otherwise(F.col("add1")).alias("added"),
    )
    begins = ~F.col("opens_in") & (F.col("after") - F.col("added") <= 1)
    ends = ~F.col("ends_in") & (F.col("after") == 1)
    state = state.select(*_RANGE, "at", "value", begins.alias("begins"), ends.alias("ends"))
    whole = state.where("begins AND ends").select(F.concat("value", F.lit("}")).alias("text"))

    parts = state.where("NOT (begins AND ends)")
    numbered = parts.withColumn("number", F.sum(F.col("begins").cast("long")).over(Window.partitionBy(*_RANGE).orderBy("at")))
    counts = parts.groupBy(*_RANGE).agg(F.sum(F.col("begins").cast("long")).alias("begun"))
    counts = counts.select(*_RANGE, _before("begun", by_file).alias("before"))
    numbered = numbered.join(counts, _RANGE).withColumn("number", F.col("number") + F.col("before"))
    put = numbered.groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("start", "at", "value"))).alias("own"), F.bool_or("ends").alias("complete")
    )
    text = F.array_join(F.transform("own", lambda x: x["value"]), "}")
    # what is left behind the last element
    put = put.select(F.when(F.col("complete"), F.concat(text, F.lit("}"))).otherwise(text).alias("text"), "complete")
    rest = F.col("text").rlike(r"^\s*\[?\s*\]?\s*\z") & ~F.col("complete")
    put = put.where(~rest).select(
        F.when(F.col("complete"), F.col("text")).otherwise(F.raise_error(F.concat(F.lit("not an array of objects: "), F.substring("text", 1, 80)))).alias("text")
    )
    objects = whole.unionByName(put).select(F.regexp_replace("text", r"^\s*[\[,]?\s*", "").alias("text"))
    kind = schema.simpleString() if isinstance(schema, StructType) else schema
    return objects.select(F.from_json("text", kind, {"mode": mode}).alias("row")).select("row.*")
