"""Role frames built from the driver's tables.

The toolkit works on a case -> sample -> analyte hierarchy. On the driver's
tables the roles are played by:

* case     = ``customer`` (``c_name`` is an 18-character barcode)
* sample   = ``orders`` (status F/O/P = benign/tumour/metastatic; barcode
  ``<c_name>-<o_orderkey>``, so the case is the barcode without its ``-NNN`` tail)
* analyte  = ``lineitem`` (``l_returnflag = 'R'`` = RNA)
* cohort   = customers of one market segment
* registry = ``labels`` for documents; derived id tables for cases and samples

Every frame here is a lazy projection/join of the parquet tables, so work grows
with the data and Catalyst prunes the columns each query does not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaweave.functions.nulls import recode

# Fixed values of the stand-in mapping.
SENTINEL = "4-NOT SPECIFIED"
COHORT_SEGMENT = "BUILDING"
OTHER_SEGMENT = "AUTOMOBILE"
STATUS_TO_SAMPLE_TYPE = [("F", "Solid Tissue Normal"), ("O", "Primary Tumor"), ("P", "Metastatic")]
STATUS_TO_CODE = [("F", "BEN"), ("O", "TUM"), ("P", "MET")]
SAMPLE_TYPE_TO_CODE = [("Solid Tissue Normal", "BEN"), ("Primary Tumor", "TUM"), ("Metastatic", "MET")]


_TABLES: dict[tuple[int, str], DataFrame] = {}


def _per_session(fn):
    """Build a role frame once per (session, folder); the frame is lazy and reusable."""
    cache: dict[tuple[int, str], DataFrame] = {}

    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (id(spark), sf_dir)
        df = cache.get(key)
        if df is None or df.sparkSession is not spark:
            df = fn(spark, sf_dir)
            cache[key] = df
        return df

    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table, opened once per session (file listing and footers are read once).

    DataFrames are immutable and lazy, so the same one can feed several branches of
    a plan; Spark gives each use its own attribute ids.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _TABLES[key] = df
    return df


@_per_session
def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("case_id"),
        F.col("c_name").alias("case_submitter_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )


@_per_session
def cohort_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case ids of the cohort (grows with the customer table)."""
    return table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == COHORT_SEGMENT).select(
        F.col("c_custkey").alias("id"))


@_per_session
def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with a barcode-like ``sample_submitter_id``."""
    o = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return o.join(cu, o.o_custkey == cu.c_custkey).select(
        F.col("o_orderkey").alias("sample_key"),
        F.col("o_custkey").alias("case_id"),
        F.col("c_name").alias("case_submitter_id"),
        F.concat(F.col("c_name"), F.lit("-"), F.col("o_orderkey").cast("string")).alias("sample_submitter_id"),
        recode("o_orderstatus", STATUS_TO_SAMPLE_TYPE).alias("sample_type"),
        F.col("o_orderpriority").alias("priority"),
    )


@_per_session
def rna_analytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RNA analytes: lineitems flagged R, with an analyte barcode."""
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return li.select(
        F.col("l_orderkey").alias("sample_key"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("analyte_submitter_id"),
        F.col("l_linenumber"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
    )
