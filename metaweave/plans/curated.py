"""Queries over curated tables: key levels, checked templates, published sets, stored codes, mergeable profiles, input order."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaweave.operators import (
    TemplateField, annotate_levels, check_template, first_appearance, merge_profiles, pivot_wider, profile_parts, stable_sort_index, with_position,
)
from metaweave.operators.codebook import encode, extend_codes
from metaweave.plans.queries import query
from metaweave.plans.standins import COHORT_SEGMENT, SENTINEL, table
from metaweave.session import ensure_checkpoint_dir
from metaweave.sources import Check, CheckFailed, publish, published


def _place(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/set-{uuid.uuid4().hex}"


@query
def match_four_levels(spark: SparkSession, d: str) -> DataFrame:
    """Lines that are no RNA, by the finest of four levels on which a large RNA line matches."""
    line = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_quantity", "l_shipdate")
    rna = line.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 40))
    aliquot = F.concat_ws("-", "l_orderkey", "l_partkey")
    donor = F.concat_ws("-", "l_partkey", "l_suppkey")
    site = F.concat_ws("-", "l_partkey", F.col("l_shipdate").cast("date").cast("string").substr(1, 7))
    levels = [("ALIQUOT", aliquot, aliquot), ("SAMPLE", "l_orderkey", "l_orderkey"), ("DONOR", donor, donor), ("SITE", site, site)]
    found = annotate_levels(line.where(F.col("l_returnflag") != "R"), rna, "level", levels)
    return found.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "level")


#: What orders must look like: some statuses, a priority of the first three ranks, a batch that is a number.
ORDER_TEMPLATE = [
    TemplateField("o_orderkey", "bigint", required=True),
    TemplateField("o_orderstatus", allowed=("F", "O"), required=True),
    TemplateField("o_orderpriority", required=True, pattern="[1-3]-[A-Z ]+"),
    TemplateField("batch", "bigint"),
    TemplateField("Country"),
]


def _checked_orders(spark: SparkSession, d: str):
    o = table(spark, d, "orders")
    mark = F.when(F.col("o_orderstatus") == "P", F.lit("P")).otherwise(F.lit(""))
    rows = o.select(
        "o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit(SENTINEL)).alias("o_orderpriority"),
        F.concat(mark, F.col("o_orderkey").cast("string")).alias("batch"), "o_custkey",
    )
    return check_template(rows, ORDER_TEMPLATE, key=["o_orderkey"])


@query
def template_conforming(spark: SparkSession, d: str) -> DataFrame:
    return _checked_orders(spark, d).conforming


@query
def template_problems(spark: SparkSession, d: str) -> DataFrame:
    return _checked_orders(spark, d).problems


def _published(spark: SparkSession, d: str) -> str:
    """Orders and their lines as two published sets, of which the second replaces the first, and a third that fails its check."""
    place = _place(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag")
    every = F.count(F.lit(1))
    parts = [Check("statuses", every, F.count_if(F.col("o_orderstatus").isin("F", "O", "P")))]
    publish({"orders": orders.withColumn("o_orderstatus", F.lit("?")), "lines": lines}, place)
    publish({"orders": orders, "lines": lines}, place, {"orders": parts})
    try:
        publish({"orders": orders.withColumn("o_orderstatus", F.lit("!")), "lines": lines}, place, {"orders": parts})
    except CheckFailed:
        return place
    raise AssertionError("a set with a failed check was published")


@query
def published_tables(spark: SparkSession, d: str) -> DataFrame:
    """Orders with the number of their lines, both from the set that readers see."""
    place = _published(spark, d)
    lines = published.read_published(spark, place, "lines").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    joined = published.read_published(spark, place, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", "o_orderstatus", F.coalesce("n", F.lit(0)).alias("n_lines"))


@query
def published_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Versions, rows and checks of every published set, as counted by the writes."""
    checks = F.col("checks")
    return published.manifest(spark, _published(spark, d)).select(
        "version", "name", "rows", F.size(checks).alias("n_checks"), F.try_element_at(checks, F.lit(1))["expected"].alias("expected"),
        F.try_element_at(checks, F.lit(1))["actual"].alias("actual"),
    )


@query
def stable_codes(spark: SparkSession, d: str) -> DataFrame:
    """Codes of customers that came in two loads, the second of which was repeated."""
    place = _place(spark)
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    extend_codes(customers.where(F.col("c_mktsegment") == COHORT_SEGMENT), "c_name", place)
    for _ in range(2):
        extend_codes(customers, "c_name", place)
    return encode(customers, "c_name", place, "code").select("c_custkey", "code")


@query
def profile_merged_years(spark: SparkSession, d: str) -> DataFrame:
    """Lines profiled by ship month, the months merged into years: the metrics that merge exactly."""
    line = table(spark, d, "lineitem")
    day = F.col("l_shipdate").cast("date")
    rows = line.select(
        F.trunc(day, "month").alias("month"), "l_quantity", F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).alias("price"), "l_returnflag"
    )
    parts = profile_parts(rows, ["month"]).withColumn("year", F.year("month"))
    merged = merge_profiles(parts, ["year"])
    return merged.where(~F.col("metric").endswith("_approx")).select("year", "column", "metric", F.round("value", 4).alias("value"))


@query
def stable_sort(spark: SparkSession, d: str) -> DataFrame:
    """Lines by ship date, ties as they stand in the file: the place of each."""
    line = with_position(table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate"))
    return stable_sort_index(line, ["l_shipdate"], name="place").select("l_orderkey", "l_partkey", "l_linenumber", "place")


@query
def pivot_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """Lines per supplier and ship month, the months as columns in the order in which the file first shows them."""
    month = F.col("l_shipdate").cast("date").cast("string").substr(1, 7)
    line = with_position(table(spark, d, "lineitem").select("l_suppkey", month.alias("month")))
    names = first_appearance(line, "month")
    counts = line.groupBy("l_suppkey", "month").agg(F.count(F.lit(1)).alias("n"))
    wide = pivot_wider(counts, "month", "n", values=names, fill=0, sort_names=False)
    # the places of the columns as values, so that the comparison sees their order
    sums = wide.agg(*[F.sum(f"`{x}`").alias(x) for x in names])
    each = F.array(*[F.struct(F.lit(i + 1).alias("place"), F.lit(x).alias("month"), F.col(f"`{x}`").alias("n")) for i, x in enumerate(wide.columns[1:])])
    return sums.select(F.inline(each))
