"""Driver queries: one per operator (or composition) of the toolkit.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables. Operators that need an eager pass (cleaning, numbering)
run it inside the call. The matching DuckDB SQL lives in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from metaweave.functions.nulls import case_when, if_else, recode
from metaweave.functions.strings import (
    drop_last,
    drop_suffix_regex,
    extract,
    last_chars,
    rewrite_path,
    str_sub,
    sub_first,
)
from metaweave.operators import (
    DEFAULT_SENTINELS,
    apply_dictionary,
    check_unique,
    top_values,
    with_row_index,
    annotate_match,
    attach_registry,
    clean_catalog,
    clean_frame,
    count_all_null_rows,
    count_groups,
    dense_code,
    dense_codes,
    distinct_values,
    drop_positions,
    drop_replicates,
    find_replicates,
    flag_membership,
    freq_table,
    full_join_na,
    group_count,
    having_count,
    join_all_na,
    join_on,
    keep_first,
    lower_names,
    match_any,
    n_unique,
    natural_join,
    pair_count,
    pivot_wider,
    prefix_names,
    profile,
    reconcile,
    relocate,
    restrict_to,
    row_sum,
    select_range,
    shared_keys,
    unpivot_longer,
)
from metaweave.plans.standins import (
    COHORT_SEGMENT,
    OTHER_SEGMENT,
    SAMPLE_TYPE_TO_CODE,
    SENTINEL,
    STATUS_TO_CODE,
    cases,
    cohort_ids,
    rna_analytes,
    samples,
    table,
)
from metaweave.plans.tables import build_manifest
from metaweave.session import materialize
from metaweave.sources.readers import id_table, null_scaffold

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _day(col: str) -> F.Column:
    # timestamp_ntz -> date -> 'yyyy-MM-dd' involves no session time zone
    return F.col(col).cast("date").cast("string").alias(col)


def _orders_nulled(spark: SparkSession, d: str) -> DataFrame:
    """orders with the 'not specified' priority as NULL and the status NULL where the priority is."""
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderpriority") == SENTINEL, F.lit(None).cast(StringType()))
        .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.nullif(F.col("o_orderpriority"), F.lit(SENTINEL)).alias("o_orderpriority"),
    )


# ============================================================================ cleaning

@query
def clean_sentinels(spark: SparkSession, d: str) -> DataFrame:
    cleaned, _ = clean_frame(table(spark, d, "orders"), sentinels=[SENTINEL])
    return cleaned.select(*[_day(x) if x == "o_orderdate" else F.col(x) for x in cleaned.columns])


@query
def drop_all_null_columns(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn(
        "o_note", F.when(F.col("o_orderstatus") == "F", F.lit("Not Reported")).otherwise(F.lit("'--")))
    cleaned, _ = clean_frame(o, sentinels=list(DEFAULT_SENTINELS) + [SENTINEL])
    return cleaned.select(*[_day(x) if x == "o_orderdate" else F.col(x) for x in cleaned.columns])


@query
def count_all_null_rows_q(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(
        F.nullif(F.col("o_orderpriority"), F.lit(SENTINEL)).alias("o_orderpriority"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast(StringType()))
        .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    return count_all_null_rows(o)


@query
def catalog_clean(spark: SparkSession, d: str) -> DataFrame:
    catalog = {
        "orders": table(spark, d, "orders").withColumn("o_note", F.lit("'--")),
        "customer": table(spark, d, "customer"),
        "nation": table(spark, d, "nation"),
    }
    cleaned, _ = clean_catalog(catalog, sentinels=list(DEFAULT_SENTINELS) + [SENTINEL])
    parts = []
    for name, df in cleaned.items():
        counts = df.agg(*[F.count(F.col(x)).alias(x) for x in df.columns])
        tall = counts.unpivot([], df.columns, "column_name", "n_nonnull").withColumn("table_name", F.lit(name))
        parts.append(tall)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "column_name", F.col("n_nonnull").cast("long").alias("n_nonnull"))


# ============================================================================ joins

@query
def shared_keys_full_join(spark: SparkSession, d: str) -> DataFrame:
    # NULL keys, and keys that only the left side has, so that both sides have rows without a partner
    left = table(spark, d, "orders").select(
        F.when((F.col("o_orderpriority") == SENTINEL) & (F.col("o_orderstatus") == "P"), F.lit(None).cast("long"))
        .when(F.col("o_orderpriority") == "5-LOW", -F.col("o_orderkey"))
        .otherwise(F.col("o_orderkey")).alias("order_id"),
        "o_custkey",
        F.col("o_orderstatus").alias("status"),
    )
    right = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_linenumber", "l_partkey", "l_suppkey",
                      F.col("l_linestatus").alias("status"))
    keys = shared_keys(left, right, pattern="id")
    return full_join_na(left, right, by=keys, suffix=("_orders", "_lineitem"))


@query
def join_all_fold(spark: SparkSession, d: str) -> DataFrame:
    shifted = lambda key, cond: F.when(cond, -F.col(key)).otherwise(F.col(key)).alias("cust_id")
    cu = table(spark, d, "customer").select(shifted("c_custkey", F.col("c_mktsegment") == "MACHINERY"), "c_name")
    o = table(spark, d, "orders").groupBy(shifted("o_custkey", F.col("o_orderstatus") == "P")).agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    ev = table(spark, d, "events").groupBy(F.col("user_id").alias("cust_id")).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    return join_all_na({"customer": cu, "orders": o, "events": ev}, by=["cust_id"], unique=("customer", "orders", "events"))


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")


@query
def natural_inner(spark: SparkSession, d: str) -> DataFrame:
    return natural_join(_docs(spark, d), table(spark, d, "labels"), how="inner")


@query
def natural_left(spark: SparkSession, d: str) -> DataFrame:
    return natural_join(_docs(spark, d), table(spark, d, "labels"), how="left")


@query
def join_renamed_key(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    cu = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return join_on(o, cu, {"o_custkey": "c_custkey"}, how="inner")


@query
def join_renamed_key_left(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    known = F.when(F.col("c_mktsegment") == COHORT_SEGMENT, F.col("c_custkey")).alias("c_custkey")
    cu = table(spark, d, "customer").select(known, "c_name")  # customers of other segments have no key here
    return join_on(o, cu, {"o_custkey": "c_custkey"}, how="left")


def _lineitem_with_case(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    o = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == SENTINEL, F.lit(None).cast("long")).otherwise(F.col("o_custkey"))
        .alias("cust_id"),
    )
    return join_on(li, o, {"l_orderkey": "o_orderkey"}, how="inner")


@query
def semi_cohort(spark: SparkSession, d: str) -> DataFrame:
    return restrict_to(_lineitem_with_case(spark, d), cohort_ids(spark, d), "cust_id", keep=True)


@query
def anti_cohort(spark: SparkSession, d: str) -> DataFrame:
    return restrict_to(_lineitem_with_case(spark, d), cohort_ids(spark, d), "cust_id", keep=False)


@query
def derived_key_membership(spark: SparkSession, d: str) -> DataFrame:
    cu = table(spark, d, "customer")
    a = cu.filter(F.col("c_mktsegment") == COHORT_SEGMENT).select("c_custkey", "c_name")
    b = cu.filter(F.col("c_mktsegment") == OTHER_SEGMENT).select("c_name")
    return flag_membership(a, b, "c_name", "flag", derive=lambda x: str_sub(x, 1, 17),
                           true_value="MATCH", false_value=None)


@query
def derived_key_anti(spark: SparkSession, d: str) -> DataFrame:
    cu = table(spark, d, "customer")
    excluded = cu.filter((F.col("c_acctbal") < 0) & (F.col("c_mktsegment") == COHORT_SEGMENT)).select("c_name")
    return restrict_to(cu.select("c_custkey", "c_name"), excluded, "c_name", keep=False,
                       derive=lambda x: drop_last(x, 1))


@query
def match_any_pattern(spark: SparkSession, d: str) -> DataFrame:
    # The pattern table of this query.
    patterns = id_table(spark, ["^red", "^blue"], name="pattern")
    return match_any(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", patterns, mode="regex")


@query
def match_any_regex_set(spark: SparkSession, d: str) -> DataFrame:
    """A pattern for about every second part, searched in the labels of all parts."""
    parts = table(spark, d, "part")
    key = F.lpad(F.col("p_partkey").cast("string"), 7, "0")
    labels = parts.select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type", key).alias("label"))
    some = parts.where("p_size <= 25")
    kind = F.col("p_partkey") % 4
    patterns = some.select(
        F.when(kind == 0, F.concat(F.lit("^"), "p_name", F.lit(".*"), key, F.lit("$")))
        .when(kind == 1, F.concat("p_brand", F.lit(" [A-Z]+ "), key))
        .when(kind == 2, F.concat(key, F.lit("$|^no such part|"), "p_type", F.lit(" "), key))
        .otherwise(F.concat("p_type", F.lit("( |-)0+"), F.col("p_partkey").cast("string"), F.lit("$"))).alias("pattern")
    )
    return match_any(labels, "label", patterns, mode="regex")


@query
def match_any_prefix(spark: SparkSession, d: str) -> DataFrame:
    cu = table(spark, d, "customer")
    patterns = cu.filter(F.col("c_acctbal") > 9000).select(drop_last(F.col("c_name"), 1).alias("pattern"))
    return match_any(cu.select("c_custkey", "c_name"), "c_name", patterns, mode="prefix")


@query
def filter_suffix_regex(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", "c_name").filter(F.col("c_name").rlike("7$"))


@query
def id_union(spark: SparkSession, d: str) -> DataFrame:
    v = cohort_ids(spark, d)
    w = table(spark, d, "events").select(F.col("user_id").alias("id")).distinct()
    return v.unionByName(w)


@query
def id_difference(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "customer").filter(F.col("c_acctbal") > 5000).select(F.col("c_custkey").alias("id"))
    w = table(spark, d, "orders").filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
    return restrict_to(v, w.select("o_custkey"), "id", keep=False)


# ============================================================================ aggregation

@query
def group_count_q(spark: SparkSession, d: str) -> DataFrame:
    return group_count(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


@query
def two_level_count(spark: SparkSession, d: str) -> DataFrame:
    return count_groups(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"], ["o_orderstatus"])


@query
def pair_count_q(spark: SparkSession, d: str) -> DataFrame:
    return pair_count(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


@query
def freq_table_no_null(spark: SparkSession, d: str) -> DataFrame:
    return freq_table(_orders_nulled(spark, d), "o_orderpriority")


@query
def unique_with_null(spark: SparkSession, d: str) -> DataFrame:
    return distinct_values(_orders_nulled(spark, d), "o_orderpriority")


@query
def n_unique_with_null(spark: SparkSession, d: str) -> DataFrame:
    return n_unique(_orders_nulled(spark, d), "o_orderpriority")


@query
def keep_first_q(spark: SparkSession, d: str) -> DataFrame:
    first = keep_first(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.select(*[_day(x) if x == "o_orderdate" else F.col(x) for x in first.columns])


@query
def having_sorted(spark: SparkSession, d: str) -> DataFrame:
    return having_count(table(spark, d, "events"), ["user_id"], lambda n: n > 70).orderBy(
        F.col("n").desc(), F.col("user_id"))


@query
def find_replicates_q(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return find_replicates(docs, F.sha2(F.col("text"), 256), key_name="text_sha256",
                           extra=[F.min("doc_id").alias("first_doc_id")])


@query
def drop_replicates_q(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars",
                                               F.sha2(F.col("text"), 256).alias("text_sha256"))
    kept = drop_replicates(docs, F.col("text_sha256"), rule="first", order_by=["doc_id"])
    return kept.select("doc_id", "lang", "source", "n_chars")


@query
def reconcile_counts(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    status = F.col("o_orderstatus")
    checks = [
        ("status_parts_vs_total", F.count(F.lit(1)),
         F.count_if(status == "F") + F.count_if(status == "O") + F.count_if(status == "P")),
        ("priority_known_plus_missing", F.count(F.lit(1)),
         F.count(F.nullif(F.col("o_orderpriority"), F.lit(SENTINEL))) + F.count_if(F.col("o_orderpriority") == SENTINEL)),
        ("urgent_vs_high", F.count_if(F.col("o_orderpriority") == "1-URGENT"),
         F.count_if(F.col("o_orderpriority") == "2-HIGH")),
    ]
    return reconcile(o, checks).withColumnRenamed("check", "check_name")


@query
def profile_columns(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(
        "o_totalprice",
        "o_custkey",
        F.nullif(F.col("o_orderpriority"), F.lit(SENTINEL)).alias("o_orderpriority"),
        F.when(F.col("o_orderpriority") == SENTINEL, F.lit(None).cast(StringType()))
        .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    prof = profile(o)
    return prof.withColumn("value", F.round("value", 4))


# ============================================================================ reshape

def _status_counts(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", recode("o_orderstatus", STATUS_TO_CODE).alias("sample_type"))
    return group_count(o, ["o_custkey", "sample_type"])


@query
def pivot_counts(spark: SparkSession, d: str) -> DataFrame:
    return pivot_wider(_status_counts(spark, d), "sample_type", "n", values=["BEN", "MET", "TUM"])


@query
def pivot_counts_fill0(spark: SparkSession, d: str) -> DataFrame:
    return pivot_wider(_status_counts(spark, d), "sample_type", "n", values=["BEN", "MET", "TUM"], fill=0)


@query
def pivot_rowsum(spark: SparkSession, d: str) -> DataFrame:
    wide = pivot_wider(_status_counts(spark, d), "sample_type", "n", values=["BEN", "MET", "TUM"], fill=0)
    return wide.withColumn("tot", row_sum(["TUM", "BEN", "MET"])).orderBy(F.col("tot").desc(), "o_custkey")


@query
def pivot_two_values(spark: SparkSession, d: str) -> DataFrame:
    conv = table(spark, d, "conversations")
    first = keep_first(conv.select("conv_id", "role", "turn", "text"), ["conv_id", "role"], ["turn"])
    return pivot_wider(first, "role", ["text", "turn"], values=["assistant", "system", "user"], id_cols=["conv_id"])


@query
def pivot_attribute_wide(spark: SparkSession, d: str) -> DataFrame:
    labelled = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    long = unpivot_longer(labelled, ["doc_id", "lang"], ["quality", "toxic"], "attribute", "value")
    return pivot_wider(long, "attribute", "value", values=["quality", "toxic"])


@query
def cohort_wide(spark: SparkSession, d: str) -> DataFrame:
    o = restrict_to(table(spark, d, "orders"), cohort_ids(spark, d), "o_custkey")
    counts = group_count(o, ["o_custkey", "o_orderpriority"])
    named = join_on(counts, table(spark, d, "customer").select("c_custkey", "c_name"), {"o_custkey": "c_custkey"})
    return pivot_wider(named, "o_orderpriority", "n",
                       values=["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])


# ============================================================================ recoding

@query
def recode_passthrough(spark: SparkSession, d: str) -> DataFrame:
    o = _orders_nulled(spark, d)
    mapping = [("1-URGENT", "high"), ("2-HIGH", "high"), ("5-LOW", None)]
    return o.select("o_orderkey", recode("o_orderpriority", mapping).alias("priority_recoded"))


@query
def case_when_map(spark: SparkSession, d: str) -> DataFrame:
    o = _orders_nulled(spark, d)
    s = F.col("o_orderstatus")
    return o.select("o_orderkey", case_when((s == "F", "BEN"), (s == "O", "TUM"), (s == "P", "MET")).alias("sample_type"))


@query
def if_else_null(spark: SparkSession, d: str) -> DataFrame:
    o = _orders_nulled(spark, d)
    return o.select("o_orderkey",
                    if_else(F.col("o_orderpriority") == "1-URGENT", "urgent", "routine").alias("urgency"))


@query
def coalesce_registry(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(
        "doc_id", F.concat(F.lit("NEW_"), F.col("doc_id").cast("string")).alias("donor_id"))
    registry = table(spark, d, "labels").select(
        "doc_id", F.concat(F.lit("REG_"), F.lpad(F.col("doc_id").cast("string"), 6, "0")).alias("donor_id"))
    return attach_registry(docs, registry, on=("doc_id", "doc_id"), prefix="reg_", replace={"donor_id": "donor_id"})


# ============================================================================ ids and strings

@query
def dense_code_q(spark: SparkSession, d: str) -> DataFrame:
    cu = table(spark, d, "customer").select("c_custkey", "c_name")
    return dense_code(cu, "c_name", "donor_code", prefix="NEW_")


@query
def across_string_codes(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    strings = [f.name for f in part.schema.fields if isinstance(f.dataType, StringType)]
    coded = dense_codes(part, strings)
    return coded.select("p_partkey", *[f"{x}_code" for x in strings], "p_size", "p_retailprice")


@query
def across_columns_long(spark: SparkSession, d: str) -> DataFrame:
    """Dense codes for five columns of mixed types, numbered together."""
    part = table(spark, d, "part")
    cols = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    coded = dense_codes(part.select("p_partkey", *cols), cols)
    return coded.select("p_partkey", *[f"{x}_code" for x in cols])


@query
def barcode_parts(spark: SparkSession, d: str) -> DataFrame:
    cu = table(spark, d, "customer")
    return cu.select("c_custkey", str_sub("c_name", 1, 12).alias("case_part"),
                     str_sub("c_name", 1, 15).alias("sample_part"), str_sub("c_name", 10, 18).alias("serial"))


@query
def strip_suffix(spark: SparkSession, d: str) -> DataFrame:
    cu = table(spark, d, "customer")
    return cu.select("c_custkey", drop_last("c_name", 1).alias("no_last"),
                     drop_suffix_regex("c_name", ".{4}").alias("no_last4"),
                     sub_first("c_name", "0", "").alias("first_zero_removed"))


@query
def last_two(spark: SparkSession, d: str) -> DataFrame:
    cu = table(spark, d, "customer")
    return cu.select("c_custkey", last_chars("c_name", 2).alias("last_two"),
                     extract("c_name", "[5-9]{2}$").alias("hi_pair"))


@query
def path_rewrite(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url")
    path = F.concat(F.lit("/data/mirror/"), F.regexp_replace("url", "^[a-z]+://", ""))
    return pages.select(
        "page_id",
        path.alias("path"),
        rewrite_path(path, old_suffix=".html", new_suffix=".cached.html").alias("html_path"),
        rewrite_path(path, old_suffix=".example", new_suffix="_x.example", literal=False).alias("quirk_path"),
    )


@query
def json_props(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


# ============================================================================ schema

# The 14-column sample template of the consortium's WGS table.
WGS_TEMPLATE = [
    ("Country", "string"), ("Donor_UUID", "string"), ("PPCG_Donor_ID", "string"), ("PPCG_Sample_ID", "string"),
    ("Local_Sample_ID", "string"), ("Local_Donor_ID", "string"), ("Sanger_UUID", "string"), ("EO_UUID", "string"),
    ("Sample_UUID", "string"), ("Matched_Normal_PPCG_Sample_ID", "string"), ("Is_Normal", "string"),
    ("Is_Normal_for_Donor", "string"), ("Sample_Type", "string"), ("Progether_ID", "string"),
]


@query
def scaffold_template(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    return null_scaffold(ids, WGS_TEMPLATE, id_column="Local_Sample_ID", fill={"Country": "USA"})


@query
def prefix_lower_relocate(spark: SparkSession, d: str) -> DataFrame:
    cu = table(spark, d, "customer")
    shaped = relocate(drop_positions(select_range(cu, "c_custkey", "c_acctbal"), [3]), "c_acctbal", before="c_name")
    return lower_names(prefix_names(shaped, "Cust_"))


# ============================================================================ annotation

@query
def annotate_match_q(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    rna = table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
    rna = join_on(rna.select("l_orderkey"), o.withColumnRenamed("o_custkey", "rna_custkey"),
                  {"l_orderkey": "o_orderkey"})
    return annotate_match(o, rna, "rna_annot", exact=("o_orderkey", "l_orderkey"), coarse=("o_custkey", "rna_custkey"))


# ============================================================================ table-building compositions

@query
def manifest(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d)
    cu = cases(spark, d)
    registry = join_on(s, cu.select("case_id", "segment"), {"case_id": "case_id"}).select(
        F.col("segment").alias("Country"),
        F.col("case_submitter_id").alias("PPCG_Donor_ID"),
        recode("sample_type", [("Solid Tissue Normal", "Benign"), ("Primary Tumor", "Tumour"),
                               ("Metastatic", "Germline")]).alias("Sample_Type"),
        F.concat(F.lit("SMP_"), F.col("sample_key").cast("string")).alias("PPCG_Sample_ID"),
        F.when(F.col("sample_type") != "Primary Tumor", "Y").otherwise("N").alias("Is_Normal"),
        F.when(F.col("sample_type") == "Metastatic", "Y").otherwise("N").alias("Is_Normal_for_Donor"),
        F.col("sample_submitter_id").alias("Local_Sample_ID"),
    )
    files = join_on(
        table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"),
        s.select("sample_key", "sample_submitter_id"), {"l_orderkey": "sample_key"},
    ).select(
        F.concat(F.lit("li_"), F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                                           F.col("l_partkey").cast("string")), F.lit(".bam")).alias("file_name"),
        F.col("sample_submitter_id").alias("sample_barcode"),
    )
    return build_manifest(files, registry, country=COHORT_SEGMENT, path_prefix="/data/wgs/")


def _wgs_specimens(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).filter(F.col("priority") == "1-URGENT").select(
        F.col("sample_submitter_id").alias("id"))


def _wgs_files(spark: SparkSession, d: str) -> DataFrame:
    first = keep_first(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
                       ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])
    files = join_on(first, samples(spark, d).select("sample_key", "sample_submitter_id"), {"l_orderkey": "sample_key"})
    return files.select(
        F.col("sample_submitter_id").alias("source_sample_id"),
        F.concat(F.lit("DO"), F.col("l_suppkey").cast("string")).alias("Archive_Donor"),
        F.concat(F.lit("SA"), F.col("l_partkey").cast("string")).alias("Sample_ID"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("Object_ID"),
    )


@query
def wgs_table(spark: SparkSession, d: str) -> DataFrame:
    tab = null_scaffold(_wgs_specimens(spark, d), WGS_TEMPLATE, id_column="Local_Sample_ID", fill={"Country": "USA"})
    tab = tab.withColumn("Local_Donor_ID", drop_suffix_regex("Local_Sample_ID", "-[0-9]+"))
    s = samples(spark, d).select("sample_submitter_id", F.col("sample_type").alias("biospecimen_type"))
    tab = join_on(tab, s, {"Local_Sample_ID": "sample_submitter_id"})
    st = F.col("biospecimen_type")
    tab = tab.withColumn("Sample_Type", case_when(
        (st == "Solid Tissue Normal", "Solid Tissue Normal (Benign)"),
        (st == "Primary Tumor", st),
        (st == "Metastatic", "Metastatic (Germline)"),
    )).drop("biospecimen_type")
    tab = join_on(tab, _wgs_files(spark, d).select("source_sample_id", "Archive_Donor", "Sample_ID", "Object_ID"),
                  {"Local_Sample_ID": "source_sample_id"})
    return tab.withColumn("Sample_UUID", F.col("Object_ID")).drop("Object_ID")


def _rna_core(spark: SparkSession, d: str) -> DataFrame:
    """RNA analytes of cohort cases, one per sample, with sample type and registry ids."""
    s = samples(spark, d)
    # replicates: keep the first analyte per sample, decided on the narrow analyte rows
    # before the joins (the sample key and barcode are one-to-one, and the cohort
    # filter keeps or drops all analytes of a sample together, so the order commutes)
    rna = drop_replicates(rna_analytes(spark, d), F.col("sample_key"), rule="first",
                          order_by=["l_linenumber", "l_partkey", "l_suppkey"])
    rna = join_on(rna, s, {"sample_key": "sample_key"})
    rna = restrict_to(rna, cohort_ids(spark, d), "case_id")
    return rna.select("case_submitter_id", "sample_submitter_id", "analyte_submitter_id", "sample_type")


def _donor_registry(spark: SparkSession, d: str) -> DataFrame:
    cu = cases(spark, d).filter(F.col("nation") < 12)
    reg = cu.select(F.concat(F.lit("DONOR_"), F.lpad(F.col("case_id").cast("string"), 6, "0")).alias("PPCG_Donor_ID"),
                    "case_submitter_id")
    return keep_first(reg, ["case_submitter_id"], ["PPCG_Donor_ID"])


def _wgs_sample_registry(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d).filter(F.col("priority") == "1-URGENT")
    reg = s.select(F.col("sample_submitter_id").alias("WGS_Local_Sample_ID"),
                   F.concat(F.lit("WGS_"), F.col("sample_key").cast("string")).alias("wgs_sample_code"))
    return keep_first(reg, ["WGS_Local_Sample_ID"], ["wgs_sample_code"])


def _new_donor_registry(spark: SparkSession, d: str) -> DataFrame:
    cu = cases(spark, d).filter(F.col("balance") > 8000)
    reg = cu.select(F.concat(F.lit("DONORN_"), F.col("case_id").cast("string")).alias("new_donor_id"),
                    F.col("case_submitter_id").alias("source_donor_id"))
    return keep_first(reg, ["new_donor_id"], ["source_donor_id"])


# The consortium's RNA table header.
RNA_COLUMNS = ["center", "PPCG_Donor_ID", "Matching_WGS_Sample", "WGS_Local_Sample_ID", "PPCG_Meth_Sample_ID",
               "Platform", "RNA_Local_Sample_ID", "RNA_Sample_Type", "MetastaticSite", "RNA_Distance_To_WGS_Sample",
               "Meth_RNAseq_annot"]


@query
def rna_table(spark: SparkSession, d: str) -> DataFrame:
    tab = _rna_core(spark, d)
    tab = join_on(tab, _donor_registry(spark, d), {"case_submitter_id": "case_submitter_id"}, how="left")
    tab = join_on(tab, _wgs_sample_registry(spark, d), {"sample_submitter_id": "WGS_Local_Sample_ID"}, how="left")
    tab = tab.withColumnRenamed("wgs_sample_code", "Matching_WGS_Sample")
    has_wgs = F.col("Matching_WGS_Sample").isNotNull()
    meth = samples(spark, d).filter(F.col("priority") == "2-HIGH").select("sample_submitter_id")
    # the sample without its last character (the vial), on both sides
    tab = flag_membership(tab, meth, "sample_submitter_id", "__meth", derive=drop_last)
    tab = tab.select(
        F.lit("USA").alias("center"),
        "PPCG_Donor_ID",
        "Matching_WGS_Sample",
        if_else(has_wgs, F.col("sample_submitter_id"), F.lit(None).cast("string")).alias("WGS_Local_Sample_ID"),
        F.lit(None).cast("string").alias("PPCG_Meth_Sample_ID"),
        F.lit("RNA_seq").alias("Platform"),
        F.col("sample_submitter_id").alias("RNA_Local_Sample_ID"),
        recode("sample_type", SAMPLE_TYPE_TO_CODE).alias("RNA_Sample_Type"),
        F.lit(None).cast("string").alias("MetastaticSite"),
        if_else(has_wgs, F.lit("MATCH"), F.lit(None).cast("string")).alias("RNA_Distance_To_WGS_Sample"),
        F.when(F.col("__meth"), F.lit("MATCH")).alias("Meth_RNAseq_annot"),
    )
    # registry ids replace the placeholder donor ids where the registry has the donor
    tab = tab.withColumn("rna_donor_id", str_sub("RNA_Local_Sample_ID", 1, 18))
    tab = attach_registry(tab, _new_donor_registry(spark, d), on=("rna_donor_id", "source_donor_id"),
                          replace={"PPCG_Donor_ID": "new_donor_id"})
    return tab.select(*RNA_COLUMNS)


# The consortium's methylation-array table header.
ASSAY_COLUMNS = ["case_submitter_id", "sample_submitter_id", "Country", "PPCG_Donor_ID", "Matching_WGS_Sample",
                 "WGS_Local_Sample_ID", "PPCG_Meth_Sample_ID", "Platform", "Meth_Local_Sample_ID", "Meth_Sample_Type",
                 "MetastaticSite", "Meth_Distance_To_WGS_Sample", "Meth_RNAseq_annot", "idat_grn_filename",
                 "idat_red_filename", "Date_of_scan_or_Sequencing"]


@query
def assay_table(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d)
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        F.when(F.col("l_linestatus") == "O", "red").otherwise("green").alias("idat"))
    # one file per sample and colour, chosen on the narrow lineitem columns before any
    # join or string building (sample barcode and order key are one-to-one)
    li = keep_first(li, ["l_orderkey", "idat"], ["l_linenumber", "l_partkey", "l_suppkey"])
    files = join_on(li, s.select("sample_key", "case_submitter_id", "sample_submitter_id", "sample_type", "priority"),
                    {"l_orderkey": "sample_key"})
    files = files.select(
        "case_submitter_id", "sample_submitter_id", "sample_type", "priority", "idat",
        F.concat(F.lit("li_"), F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                                           F.col("l_partkey").cast("string")), F.lit(".idat")).alias("file_name"),
        _day("l_shipdate").alias("updated_datetime"),
    )
    # keep_first left one file per (sample, colour), so no cell can hold two values
    wide = pivot_wider(files, "idat", ["file_name", "updated_datetime"], values=["green", "red"],
                       id_cols=["case_submitter_id", "sample_submitter_id", "sample_type", "priority"],
                       on_duplicate="first")
    # curated exclusions: low-priority samples are the replicates to remove
    bad = s.filter(F.col("priority") == "5-LOW").select("sample_submitter_id")
    wide = restrict_to(wide, bad, "sample_submitter_id", keep=False)
    # one row per sample from here on: evaluate the file-level plan once
    wide = materialize(wide)
    wide = dense_code(wide, "case_submitter_id", "PPCG_Donor_ID", prefix="NEW_")
    wide = flag_membership(wide, _wgs_specimens(spark, d), "sample_submitter_id", "__wgs")
    st = F.col("sample_type")
    tab = wide.select(
        "case_submitter_id",
        "sample_submitter_id",
        F.lit("USA").alias("Country"),
        "PPCG_Donor_ID",
        F.when(F.col("__wgs"), F.lit("ADD")).alias("Matching_WGS_Sample"),
        F.when(F.col("__wgs"), F.col("sample_submitter_id")).alias("WGS_Local_Sample_ID"),
        F.lit(None).cast("string").alias("PPCG_Meth_Sample_ID"),
        F.lit("450K").alias("Platform"),
        F.col("sample_submitter_id").alias("Meth_Local_Sample_ID"),
        case_when((st == "Solid Tissue Normal", "BEN"), (st == "Primary Tumor", "TUM"), (st == "Metastatic", "MET"))
        .alias("Meth_Sample_Type"),
        F.lit(None).cast("string").alias("MetastaticSite"),
        F.when(F.col("__wgs"), F.lit("MATCHED")).alias("Meth_Distance_To_WGS_Sample"),
        F.col("file_name_green").alias("idat_grn_filename"),
        F.col("file_name_red").alias("idat_red_filename"),
        F.lit(None).cast("string").alias("Date_of_scan_or_Sequencing"),
    )
    # RNA annotation: same sample -> MATCHED, same donor -> DISTANT
    rna = join_on(rna_analytes(spark, d).select("sample_key"), s.select("sample_key", "case_submitter_id",
                                                                         "sample_submitter_id"),
                  {"sample_key": "sample_key"}).select(F.col("case_submitter_id").alias("rna_case"),
                                                       F.col("sample_submitter_id").alias("rna_sample"))
    tab = annotate_match(tab, rna, "Meth_RNAseq_annot", exact=("sample_submitter_id", "rna_sample"),
                         coarse=("case_submitter_id", "rna_case"))
    return tab.select(*ASSAY_COLUMNS)


@query
def clinical_dictionary(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "customer")
    raw = raw.toDF(*[x.upper() for x in raw.columns])  # the legacy export has upper-case headers
    clinical = apply_dictionary(
        lower_names(raw),
        renames={"c_name": "local_donor_id", "c_acctbal": "balance", "c_mktsegment": "segment",
                 "c_nationkey": "nation"},
        keep=["local_donor_id", "nation", "balance", "segment"],
        recodes={"segment": [("BUILDING", "building"), ("AUTOMOBILE", None), ("MACHINERY", "machinery")]},
    )
    clinical = clinical.withColumn("status", if_else(F.col("balance") < 0, "negative", "positive"))
    clinical = clinical.withColumn("segment", if_else(F.col("status") == "negative", F.lit("negative"),
                                                      F.col("segment")))
    meth = samples(spark, d).filter((F.col("sample_type") == "Primary Tumor") & (F.col("priority") == "2-HIGH"))
    meth = meth.select(F.concat(F.lit("METH_"), F.col("sample_key").cast("string")).alias("PPCG_Meth_Sample_ID"),
                       F.col("sample_submitter_id").alias("Meth_Local_Sample_ID"))
    meth = meth.withColumn("local_donor_id", drop_suffix_regex("Meth_Local_Sample_ID", "-[0-9]+"))
    out = natural_join(meth, clinical, how="left")
    from metaweave.operators.ids import with_row_index

    indexed = with_row_index(out, ["Meth_Local_Sample_ID"], name="row_index")
    return indexed.select("row_index", *out.columns)


@query
def donors_by_attribute(spark: SparkSession, d: str) -> DataFrame:
    cu = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    clinical = cu.select(F.col("c_custkey").alias("case_id"), F.col("c_name").alias("case_submitter_id"),
                         F.col("n_name").alias("race"))
    clinical = restrict_to(clinical, cohort_ids(spark, d), "case_id")
    donor_sample = _wgs_specimens(spark, d).select(
        F.col("id").alias("sample_submitter_id"),
        drop_suffix_regex(F.col("id"), "-[0-9]+").alias("case_submitter_id"))
    joined = natural_join(clinical, donor_sample)
    first = keep_first(joined, ["case_submitter_id"], ["sample_submitter_id"])
    return first.filter(F.col("race") == "NATION_7")


@query
def biospecimen_flat(spark: SparkSession, d: str) -> DataFrame:
    case = table(spark, d, "customer").select(F.col("c_custkey").alias("case_id"),
                                              F.col("c_name").alias("case_submitter_id"),
                                              F.col("c_mktsegment").alias("segment"))
    sample = table(spark, d, "orders").select(F.col("o_orderkey").alias("sample_id"),
                                              F.col("o_custkey").alias("case_id"),
                                              F.col("o_orderstatus").alias("status"))
    analyte = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("sample_id"), "l_linenumber", "l_partkey",
                                                 "l_suppkey", F.col("l_returnflag").alias("analyte_type_id"),
                                                 F.col("l_linestatus").alias("status"))
    flat = full_join_na(analyte, sample, pattern="id", suffix=("_analyte", "_sample"))
    flat = full_join_na(flat, case, pattern="id")
    return flat.withColumn("analyte_type_id", recode("analyte_type_id", [("R", "RNA"), ("A", "DNA"),
                                                                         ("N", "Total RNA")]))


@query
def drop_replicates_suffix(spark: SparkSession, d: str) -> DataFrame:
    """Among customers sharing a name without its last digit, drop the 'second vial' (last digit 5-9)."""
    cu = table(spark, d, "customer").select("c_custkey", "c_name")
    return drop_replicates(cu, drop_last(F.col("c_name"), 1), rule="suffix", pattern="[5-9]$", column="c_name")


@query
def drop_replicates_exclude(spark: SparkSession, d: str) -> DataFrame:
    """Remove a curated exclusion list (low-priority urgent orders) by exact sample id."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    bad = table(spark, d, "orders").filter((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"))
    return drop_replicates(o, F.col("o_orderkey"), rule="exclude", exclude=bad.select("o_orderkey"),
                           column="o_orderkey")


@query
def row_index(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", _day("o_orderdate"))
    return with_row_index(o, ["o_orderdate", "o_orderkey"], name="row_index")


@query
def top_priorities(spark: SparkSession, d: str) -> DataFrame:
    o = _orders_nulled(spark, d)
    return top_values(o, ["o_orderpriority", "o_orderstatus"], k=3).withColumn("rank", F.col("rank").cast("long"))


@query
def registry_unique_join(spark: SparkSession, d: str) -> DataFrame:
    """Many-to-one join guarded by a uniqueness probe on the registry key."""
    reg = check_unique(table(spark, d, "labels"), ["doc_id"], what="labels")
    return join_on(table(spark, d, "documents").select("doc_id", "source"), reg, {"doc_id": "doc_id"}, how="left")


@query
def center_codes(spark: SparkSession, d: str) -> DataFrame:
    """Distinct analysing-centre codes: the last two characters of the RNA analyte barcodes."""
    rna = restrict_to(join_on(rna_analytes(spark, d), samples(spark, d).select("sample_key", "case_id"),
                              {"sample_key": "sample_key"}), cohort_ids(spark, d), "case_id")
    return distinct_values(rna.select(last_chars("analyte_submitter_id", 2).alias("center")), "center")


@query
def technical_replicates(spark: SparkSession, d: str) -> DataFrame:
    """Donors with exactly two sample pairs of one type (two files per sample, so n/2 == 2)."""
    pairs = pair_count(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"])
    return distinct_values(pairs.filter(F.col("n") == 2).select("o_custkey"), "o_custkey")


@query
def donor_extra_sample(spark: SparkSession, d: str) -> DataFrame:
    """Donors with more than one urgent sample, minus donors of the not-matched samples (by barcode stem)."""
    s = samples(spark, d)
    extra = having_count(s.filter(F.col("priority") == "1-URGENT"), ["case_submitter_id"], lambda n: n > 1)
    not_matched = s.filter((F.col("priority") == "2-HIGH") & (F.col("sample_type") == "Metastatic")).select(
        "sample_submitter_id")
    return restrict_to(extra, not_matched, "case_submitter_id", keep=False,
                       derive_ids=lambda x: drop_suffix_regex(x, "-[0-9]+"))


@query
def replicate_rule(spark: SparkSession, d: str) -> DataFrame:
    """Samples without later replicates: of samples that differ in the last character only, those that end in 5 to 9 go."""
    s = samples(spark, d).select("case_submitter_id", "sample_submitter_id", "sample_type")
    several = having_count(s.select(drop_last("sample_submitter_id").alias("sample_id")), ["sample_id"], lambda n: n > 1)
    later = match_any(s.select("sample_submitter_id"), "sample_submitter_id", several.select("sample_id"), mode="prefix")
    later = later.filter(F.col("sample_submitter_id").rlike("[5-9]$"))
    return restrict_to(s, later, "sample_submitter_id", keep=False)


@query
def derived_key_exclusion(spark: SparkSession, d: str) -> DataFrame:
    """Samples whose vial-free barcode is not that of a low-priority sample; flags a vial-free match with urgent ones."""
    s = samples(spark, d)
    bad = s.filter(F.col("priority") == "5-LOW").select("sample_submitter_id")
    urgent = s.filter(F.col("priority") == "1-URGENT").select("sample_submitter_id")
    left = restrict_to(s.select("sample_submitter_id", "sample_type"), bad, "sample_submitter_id", keep=False, derive=drop_last)
    return flag_membership(left, urgent, "sample_submitter_id", "matching", derive=drop_last, true_value="MATCH", false_value=None)


def queries() -> dict[str, Query]:
    """Registered queries, keyed without the ``_q`` suffix used to avoid name clashes."""
    return {(k[:-2] if k.endswith("_q") else k): v for k, v in REGISTRY.items()}
