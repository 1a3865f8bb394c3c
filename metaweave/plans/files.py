"""Queries over sources and sinks: tables are written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metaweave.functions.nulls import concat_na
from metaweave.operators import catalog_columns, conform, histogram, join_all_na, restrict_to, with_row_index
from metaweave.plans.queries import query
from metaweave.plans.standins import SENTINEL, table
from metaweave.session import ensure_checkpoint_dir
from metaweave.sources import read_json_array_ranges, readers, writers


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"


def _orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select("o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit(SENTINEL)).alias("o_orderpriority"))


@query
def tsv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark)
    writers.write_tsv(_orders(spark, d), path)
    return readers.read_tsv(spark, path)


@query
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark)
    writers.write_csv(_orders(spark, d), path)
    return readers.read_csv(spark, path)


@query
def csv_index_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark)
    writers.write_csv_indexed(table(spark, d, "customer").select("c_name", "c_mktsegment"), path, ["c_name"])
    return readers.read_csv(spark, path).withColumnRenamed("_c0", "row_index")


@query
def orders_types_guessed(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark)
    writers.write_tsv(table(spark, d, "orders"), path)
    return readers.read_tsv(spark, path, guess=True)


@query
def lineitem_types_guessed(spark: SparkSession, d: str) -> DataFrame:
    """Types of all rows of a wide table; a day without time, a flag and an identifier with zeros among them."""
    path = _folder(spark)
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", F.to_date("l_shipdate").alias("ship_day"),
        (F.col("l_tax") > 0).alias("taxed"), F.lpad(F.col("l_partkey").cast("string"), 9, "0").alias("part_code"),
        F.when(F.col("l_linenumber") > 1, F.col("l_suppkey")).alias("supplier"),
    )
    writers.write_tsv(li, path)
    return readers.read_tsv(spark, path, guess=True)


@query
def tables_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Several tables saved twice to one place, the second time over the first, and reloaded."""
    folder = _folder(spark)
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    writers.save_tables({"orders": customers, "customer": customers}, folder)
    paths = writers.save_tables({"orders": _orders(spark, d), "customer": customers}, folder)
    keys = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    orders, customer = (readers.read_checkpoint(spark, paths[x]) for x in ("orders", "customer"))
    joined = orders.join(keys, "o_orderkey").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "o_orderstatus", "c_name", "c_mktsegment")


@query
def catalog_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A folder of TSVs read as a catalogue by listing it: rows and columns of each table."""
    folder = _folder(spark)
    for name in ("customer", "orders", "supplier"):
        writers.write_tsv(table(spark, d, name), f"{folder}/{name}.tsv")
    parts = [
        df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))
        for name, df in readers.read_catalog(spark, folder).items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def commented_tsv(spark: SparkSession, d: str) -> DataFrame:
    """Every task writes a file with a commented header, comment lines and comments behind cells; the comments are cut."""
    path = _folder(spark)
    orders = table(spark, d, "orders")
    note = F.when(F.col("o_orderkey") % 3 == 0, F.lit("  # a note, with more")).otherwise(F.lit(""))
    name = "o_orderpriority # names"
    rows = orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.concat("o_orderpriority", note).alias(name))
    remarks = orders.where("o_orderstatus = 'P'").select(F.lit("# a line of its own").alias("o_orderkey"), F.lit(None).cast("string").alias(name))
    writers.write_tsv(rows.unionByName(remarks), path)
    return readers.read_commented_tsv(spark, path)


#: Objects of one JSON array, so that no task gathers more.
ARRAY_ROWS = 20_000


@query
def json_array_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Orders as files of one JSON array each; there are as many files as the table needs."""
    path = _folder(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    files = orders.count() // ARRAY_ROWS + 1
    bucket = F.pmod(F.xxhash64("o_orderkey"), F.lit(files)).alias("bucket")
    arrays = orders.groupBy(bucket).agg(F.to_json(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("value"))
    arrays.write.partitionBy("bucket").text(path)
    return readers.read_json_array(spark, path, "o_orderkey long, o_orderpriority string").select("o_orderkey", "o_orderpriority")


#: Objects of one large file; its rows go through one task as they are written, but are never held.
FILE_ROWS = 2_000_000


@query
def json_array_by_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Orders as one array a file, with nested objects and texts full of quotes and braces, read by byte ranges."""
    path = _folder(spark)
    orders = table(spark, d, "orders")
    files = orders.count() // FILE_ROWS + 1
    odd = F.when(F.col("o_orderkey") % 5 == 0, F.lit(' "}, {\\"a\\": [')).otherwise(F.lit(""))
    fields = F.struct(
        "o_orderkey", F.concat("o_orderpriority", odd).alias("note"), F.when(F.col("o_orderkey") % 3 == 0, F.struct("o_custkey", "o_orderstatus")).alias("who")
    )
    rows = orders.select(F.pmod(F.xxhash64("o_orderkey"), F.lit(files)).alias("bucket"), F.lit(1).alias("part"), F.to_json(fields).alias("value"))
    ends = spark.range(files).select(F.col("id").alias("bucket"), F.explode(F.array(F.lit(0), F.lit(2))).alias("part"))
    rows = rows.unionByName(ends.withColumn("value", F.when(F.col("part") == 0, F.lit("[")).otherwise(F.lit("]"))))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("part", "value"))
    comma = F.when((F.col("part") == 1) & (place > 2), F.lit(",")).otherwise(F.lit(""))
    rows.select("bucket", F.concat(comma, "value").alias("value")).write.partitionBy("bucket").option("lineSep", " ").text(path)
    back = read_json_array_ranges(spark, path, "o_orderkey long, note string, who struct<o_custkey: long, o_orderstatus: string>")
    return back.select("o_orderkey", "note", F.col("who.o_custkey").alias("custkey"), F.col("who.o_orderstatus").alias("status"))


@query
def literal_id_set(spark: SparkSession, d: str) -> DataFrame:
    ids = readers.id_table(spark, ["1-URGENT", "5-LOW", None])
    return restrict_to(_orders(spark, d), ids, "o_orderpriority")


@query
def concat_with_na(spark: SparkSession, d: str) -> DataFrame:
    return _orders(spark, d).select("o_orderkey", concat_na("o_orderstatus", F.lit("/"), "o_orderpriority", na_text="NA").alias("label"))


@query
def conform_template(spark: SparkSession, d: str) -> DataFrame:
    template = [("o_orderpriority", "string"), ("Country", "string"), ("o_orderkey", "string"), ("o_orderstatus", "int")]
    return conform(_orders(spark, d), template)


@query
def catalog_names(spark: SparkSession, d: str) -> DataFrame:
    """The columns of every table of a catalogue, with the rows of the table and the values of the column."""
    tables = {x: table(spark, d, x) for x in ("customer", "orders")}
    counts = None
    for name, df in tables.items():
        held = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(F.col(x)).alias(x) for x in df.columns])
        tall = held.unpivot("n_rows", df.columns, "column", "n_values").withColumn("table", F.lit(name))
        counts = tall if counts is None else counts.unionByName(tall)
    return catalog_columns(spark, tables).join(counts, ["table", "column"]).select("table", "position", "column", "n_rows", "n_values")


@query
def sorted_positions(spark: SparkSession, d: str) -> DataFrame:
    """Orders by descending price: the place of each row, so that the comparison sees the order."""
    o = table(spark, d, "orders").select("o_orderkey", (-F.col("o_totalprice")).alias("below"))
    return with_row_index(o, ["below", "o_orderkey"], name="place").select("o_orderkey", "place")


@query
def profile_histogram(spark: SparkSession, d: str) -> DataFrame:
    return histogram(table(spark, d, "lineitem").select("l_quantity", "l_linenumber"), ["l_quantity", "l_linenumber"])


@query
def join_all_found_keys(spark: SparkSession, d: str) -> DataFrame:
    """An N-way full join on the key that all tables share; one key is text, one value name differs in case."""
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("cust_id")).agg(F.count(F.lit(1)).alias("N"))
    e = table(spark, d, "events").groupBy(F.col("user_id").alias("cust_id")).agg(F.count(F.lit(1)).alias("n"))
    cu = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("cust_id"), "c_name")
    out = join_all_na({"customer": cu, "orders": o, "events": e}, unique=("customer", "orders", "events"))
    return out.toDF("cust_id", "c_name", "n_orders", "n_events")
