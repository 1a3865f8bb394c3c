"""DuckDB SQL equivalents of the driver queries (same column names and types).

Views ``region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations`` are registered by the caller.
NULL-matching joins use ``IS NOT DISTINCT FROM``; anti joins use ``NOT EXISTS``.
"""

from __future__ import annotations

SENT = "'4-NOT SPECIFIED'"

ORDERS_NULLED = f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderpriority = {SENT} THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       NULLIF(o_orderpriority, {SENT}) AS o_orderpriority
FROM orders"""

SAMPLES = """
SELECT o.o_orderkey AS sample_key, o.o_custkey AS case_id, c.c_name AS case_submitter_id,
       c.c_name || '-' || CAST(o.o_orderkey AS VARCHAR) AS sample_submitter_id,
       CASE o.o_orderstatus WHEN 'F' THEN 'Solid Tissue Normal' WHEN 'O' THEN 'Primary Tumor'
            WHEN 'P' THEN 'Metastatic' ELSE o.o_orderstatus END AS sample_type,
       o.o_orderpriority AS priority
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

COHORT = "SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING'"

LINEITEM_WITH_CASE = f"""
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber,
       CASE WHEN o.o_orderpriority = {SENT} THEN NULL ELSE o.o_custkey END AS cust_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

STATUS_COUNTS = """
SELECT o_custkey,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS BEN,
       count(*) FILTER (WHERE o_orderstatus = 'P') AS MET,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS TUM
FROM orders GROUP BY o_custkey"""

# The 14-column sample template of the consortium's WGS table.
WGS_TEMPLATE_NAMES = [
    "Country", "Donor_UUID", "PPCG_Donor_ID", "PPCG_Sample_ID", "Local_Sample_ID", "Local_Donor_ID", "Sanger_UUID",
    "EO_UUID", "Sample_UUID", "Matched_Normal_PPCG_Sample_ID", "Is_Normal", "Is_Normal_for_Donor", "Sample_Type",
    "Progether_ID",
]


def _profile_sql() -> str:
    cols = {"o_totalprice": True, "o_custkey": True, "o_orderpriority": False, "o_orderstatus": False}
    base = f"""(SELECT n.o_custkey, n.o_orderstatus, n.o_orderpriority, o.o_totalprice
               FROM ({ORDERS_NULLED}) n JOIN orders o ON n.o_orderkey = o.o_orderkey)"""
    parts = []
    for col, numeric in cols.items():
        metrics = [
            ("n_missing", f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS DOUBLE)"),
            ("complete_rate", f"1.0 - CAST(count(*) FILTER (WHERE {col} IS NULL) AS DOUBLE) / count(*)"),
            ("n_unique", f"CAST(count(DISTINCT {col}) AS DOUBLE)"),
        ]
        if numeric:
            metrics += [
                ("mean", f"avg(CAST({col} AS DOUBLE))"),
                ("sd", f"stddev_samp(CAST({col} AS DOUBLE))"),
                ("p0", f"CAST(min({col}) AS DOUBLE)"),
                ("p25", f"CAST(quantile_disc({col}, 0.25) AS DOUBLE)"),
                ("p50", f"CAST(quantile_disc({col}, 0.5) AS DOUBLE)"),
                ("p75", f"CAST(quantile_disc({col}, 0.75) AS DOUBLE)"),
                ("p100", f"CAST(max({col}) AS DOUBLE)"),
            ]
        for name, expr in metrics:
            parts.append(f"SELECT '{col}' AS \"column\", '{name}' AS metric, round({expr}, 4) AS value FROM {base}")
    return "\nUNION ALL\n".join(parts)


def _catalog_sql() -> str:
    tables = {
        "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        "nation": ["n_nationkey", "n_name", "n_regionkey"],
    }
    parts = []
    for t, cols in tables.items():
        for col in cols:
            expr = f"count(NULLIF({col}, {SENT}))" if col == "o_orderpriority" else f"count({col})"
            parts.append(f"SELECT '{t}' AS table_name, '{col}' AS column_name, CAST({expr} AS BIGINT) AS n_nonnull FROM {t}")
    return "\nUNION ALL\n".join(parts)


def _rna_sql() -> str:
    return f"""
WITH s AS ({SAMPLES}),
rna AS (
  SELECT l.l_orderkey AS sample_key,
         concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR), CAST(l.l_partkey AS VARCHAR),
                   CAST(l.l_suppkey AS VARCHAR)) AS analyte_submitter_id,
         l.l_linenumber, l.l_partkey, l.l_suppkey
  FROM lineitem l WHERE l.l_returnflag = 'R'),
j AS (
  SELECT r.*, s.case_id, s.case_submitter_id, s.sample_submitter_id, s.sample_type
  FROM rna r JOIN s ON r.sample_key = s.sample_key
  WHERE EXISTS (SELECT 1 FROM ({COHORT}) c WHERE c.id IS NOT DISTINCT FROM s.case_id)),
core AS (
  SELECT case_submitter_id, sample_submitter_id, analyte_submitter_id, sample_type FROM (
    SELECT *, row_number() OVER (PARTITION BY sample_submitter_id
                                 ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM j) WHERE rn = 1),
donor_reg AS (
  SELECT min('DONOR_' || lpad(CAST(c_custkey AS VARCHAR), 6, '0')) AS PPCG_Donor_ID, c_name AS case_submitter_id
  FROM customer WHERE c_nationkey < 12 GROUP BY c_name),
wgs_reg AS (
  SELECT sample_submitter_id AS WGS_Local_Sample_ID, min('WGS_' || CAST(sample_key AS VARCHAR)) AS wgs_sample_code
  FROM s WHERE priority = '1-URGENT' GROUP BY sample_submitter_id),
meth AS (SELECT DISTINCT left(sample_submitter_id, length(sample_submitter_id) - 1) AS k FROM s WHERE priority = '2-HIGH'),
new_reg AS (
  SELECT new_donor_id, min(source_donor_id) AS source_donor_id FROM (
    SELECT 'DONORN_' || CAST(c_custkey AS VARCHAR) AS new_donor_id, c_name AS source_donor_id
    FROM customer WHERE c_acctbal > 8000) GROUP BY new_donor_id),
t AS (
  SELECT 'USA' AS center, d.PPCG_Donor_ID, w.wgs_sample_code AS Matching_WGS_Sample,
         CASE WHEN w.wgs_sample_code IS NOT NULL THEN core.sample_submitter_id END AS WGS_Local_Sample_ID,
         CAST(NULL AS VARCHAR) AS PPCG_Meth_Sample_ID, 'RNA_seq' AS Platform,
         core.sample_submitter_id AS RNA_Local_Sample_ID,
         CASE core.sample_type WHEN 'Solid Tissue Normal' THEN 'BEN' WHEN 'Primary Tumor' THEN 'TUM'
              WHEN 'Metastatic' THEN 'MET' ELSE core.sample_type END AS RNA_Sample_Type,
         CAST(NULL AS VARCHAR) AS MetastaticSite,
         CASE WHEN w.wgs_sample_code IS NOT NULL THEN 'MATCH' END AS RNA_Distance_To_WGS_Sample,
         CASE WHEN EXISTS (SELECT 1 FROM meth m
                           WHERE m.k = left(core.sample_submitter_id, length(core.sample_submitter_id) - 1))
              THEN 'MATCH' END AS Meth_RNAseq_annot
  FROM core
  LEFT JOIN donor_reg d ON core.case_submitter_id IS NOT DISTINCT FROM d.case_submitter_id
  LEFT JOIN wgs_reg w ON core.sample_submitter_id IS NOT DISTINCT FROM w.WGS_Local_Sample_ID)
SELECT t.center, COALESCE(n.new_donor_id, t.PPCG_Donor_ID) AS PPCG_Donor_ID, t.Matching_WGS_Sample,
       t.WGS_Local_Sample_ID, t.PPCG_Meth_Sample_ID, t.Platform, t.RNA_Local_Sample_ID, t.RNA_Sample_Type,
       t.MetastaticSite, t.RNA_Distance_To_WGS_Sample, t.Meth_RNAseq_annot
FROM t LEFT JOIN new_reg n ON substr(t.RNA_Local_Sample_ID, 1, 18) IS NOT DISTINCT FROM n.source_donor_id"""


def _assay_sql() -> str:
    return f"""
WITH s AS ({SAMPLES}),
f AS (
  SELECT s.case_submitter_id, s.sample_submitter_id, s.sample_type, s.priority,
         l.l_linenumber, l.l_partkey, l.l_suppkey,
         CASE WHEN l.l_linestatus = 'O' THEN 'red' ELSE 'green' END AS idat,
         'li_' || concat_ws('_', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
                            CAST(l.l_partkey AS VARCHAR)) || '.idat' AS file_name,
         strftime(l.l_shipdate, '%Y-%m-%d') AS updated_datetime
  FROM lineitem l JOIN s ON l.l_orderkey = s.sample_key),
f1 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_submitter_id, idat
                                              ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM f)
  WHERE rn = 1),
w AS (
  SELECT case_submitter_id, sample_submitter_id, sample_type, priority,
         min(file_name) FILTER (WHERE idat = 'green') AS file_name_green,
         min(file_name) FILTER (WHERE idat = 'red') AS file_name_red
  FROM f1 GROUP BY case_submitter_id, sample_submitter_id, sample_type, priority),
w2 AS (
  SELECT * FROM w WHERE NOT EXISTS (
    SELECT 1 FROM s b WHERE b.priority = '5-LOW' AND b.sample_submitter_id IS NOT DISTINCT FROM w.sample_submitter_id)),
codes AS (
  SELECT case_submitter_id AS v, 'NEW_' || CAST(dense_rank() OVER (ORDER BY case_submitter_id) AS VARCHAR) AS code
  FROM (SELECT DISTINCT case_submitter_id FROM w2 WHERE case_submitter_id IS NOT NULL)),
wgs AS (SELECT DISTINCT sample_submitter_id AS id FROM s WHERE priority = '1-URGENT'),
rna AS (
  SELECT s.case_submitter_id AS rna_case, s.sample_submitter_id AS rna_sample
  FROM lineitem l JOIN s ON l.l_orderkey = s.sample_key WHERE l.l_returnflag = 'R'),
t AS (
  SELECT w2.*, codes.code AS PPCG_Donor_ID,
         EXISTS (SELECT 1 FROM wgs WHERE wgs.id IS NOT DISTINCT FROM w2.sample_submitter_id) AS is_wgs
  FROM w2 LEFT JOIN codes ON w2.case_submitter_id = codes.v)
SELECT case_submitter_id, sample_submitter_id, 'USA' AS Country, PPCG_Donor_ID,
       CASE WHEN is_wgs THEN 'ADD' END AS Matching_WGS_Sample,
       CASE WHEN is_wgs THEN sample_submitter_id END AS WGS_Local_Sample_ID,
       CAST(NULL AS VARCHAR) AS PPCG_Meth_Sample_ID, '450K' AS Platform,
       sample_submitter_id AS Meth_Local_Sample_ID,
       CASE WHEN sample_type = 'Solid Tissue Normal' THEN 'BEN' WHEN sample_type = 'Primary Tumor' THEN 'TUM'
            WHEN sample_type = 'Metastatic' THEN 'MET' END AS Meth_Sample_Type,
       CAST(NULL AS VARCHAR) AS MetastaticSite,
       CASE WHEN is_wgs THEN 'MATCHED' END AS Meth_Distance_To_WGS_Sample,
       CASE WHEN EXISTS (SELECT 1 FROM rna WHERE rna.rna_sample IS NOT DISTINCT FROM t.sample_submitter_id) THEN 'MATCHED'
            WHEN EXISTS (SELECT 1 FROM rna WHERE rna.rna_case IS NOT DISTINCT FROM t.case_submitter_id) THEN 'DISTANT'
       END AS Meth_RNAseq_annot,
       file_name_green AS idat_grn_filename, file_name_red AS idat_red_filename,
       CAST(NULL AS VARCHAR) AS Date_of_scan_or_Sequencing
FROM t"""


def _wgs_sql() -> str:
    null_cols = {n: f"CAST(NULL AS VARCHAR) AS {n}" for n in WGS_TEMPLATE_NAMES}
    null_cols["Country"] = "'USA' AS Country"
    null_cols["Local_Sample_ID"] = "x.sample_submitter_id AS Local_Sample_ID"
    null_cols["Local_Donor_ID"] = "regexp_replace(x.sample_submitter_id, '(?:-[0-9]+)$', '') AS Local_Donor_ID"
    null_cols["Sample_Type"] = """CASE WHEN x.sample_type = 'Solid Tissue Normal' THEN 'Solid Tissue Normal (Benign)'
            WHEN x.sample_type = 'Primary Tumor' THEN x.sample_type
            WHEN x.sample_type = 'Metastatic' THEN 'Metastatic (Germline)' END AS Sample_Type"""
    null_cols["Sample_UUID"] = "f.Object_ID AS Sample_UUID"
    cols = ",\n       ".join(null_cols[n] for n in WGS_TEMPLATE_NAMES)
    return f"""
WITH s AS ({SAMPLES}),
x AS (SELECT * FROM s WHERE priority = '1-URGENT'),
first_li AS (
  SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
                 FROM lineitem) WHERE rn = 1),
f AS (
  SELECT s.sample_submitter_id AS source_sample_id, 'DO' || CAST(first_li.l_suppkey AS VARCHAR) AS Archive_Donor,
         'SA' || CAST(first_li.l_partkey AS VARCHAR) AS Sample_ID,
         CAST(first_li.l_orderkey AS VARCHAR) || '-' || CAST(first_li.l_linenumber AS VARCHAR) AS Object_ID
  FROM first_li JOIN s ON first_li.l_orderkey = s.sample_key)
SELECT {cols},
       f.Archive_Donor, f.Sample_ID
FROM x JOIN f ON x.sample_submitter_id = f.source_sample_id"""


def _manifest_sql() -> str:
    return f"""
WITH s AS ({SAMPLES}),
reg AS (
  SELECT c.c_name AS PPCG_Donor_ID,
         CASE s.sample_type WHEN 'Solid Tissue Normal' THEN 'Benign' WHEN 'Primary Tumor' THEN 'Tumour'
              WHEN 'Metastatic' THEN 'Germline' ELSE s.sample_type END AS Sample_Type,
         'SMP_' || CAST(s.sample_key AS VARCHAR) AS PPCG_Sample_ID,
         CASE WHEN s.sample_type != 'Primary Tumor' THEN 'Y' ELSE 'N' END AS Is_Normal,
         CASE WHEN s.sample_type = 'Metastatic' THEN 'Y' ELSE 'N' END AS Is_Normal_for_Donor,
         s.sample_submitter_id AS Local_Sample_ID
  FROM s JOIN customer c ON s.case_id = c.c_custkey WHERE c.c_mktsegment = 'BUILDING'),
files AS (
  SELECT 'li_' || concat_ws('_', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
                            CAST(l.l_partkey AS VARCHAR)) || '.bam' AS file_name,
         s.sample_submitter_id AS sample_barcode
  FROM lineitem l JOIN s ON l.l_orderkey = s.sample_key)
SELECT reg.PPCG_Donor_ID AS Donor_ID, reg.Sample_Type AS Tissue_ID, reg.Is_Normal AS is_normal,
       reg.Is_Normal_for_Donor AS is_normal_for_donor, reg.PPCG_Sample_ID AS Sample_ID,
       regexp_replace('/data/wgs/' || files.file_name, '\\.bam$', '_unmapped.bam') AS relative_file_path
FROM files JOIN reg ON files.sample_barcode IS NOT DISTINCT FROM reg.Local_Sample_ID"""


def _clinical_sql() -> str:
    return f"""
WITH s AS ({SAMPLES}),
clin AS (
  SELECT c_name AS local_donor_id, c_nationkey AS nation, c_acctbal AS balance,
         CASE WHEN c_acctbal < 0 THEN 'negative'
              ELSE CASE c_mktsegment WHEN 'BUILDING' THEN 'building' WHEN 'AUTOMOBILE' THEN NULL
                                     WHEN 'MACHINERY' THEN 'machinery' ELSE c_mktsegment END END AS segment,
         CASE WHEN c_acctbal < 0 THEN 'negative' ELSE 'positive' END AS status
  FROM customer),
meth AS (
  SELECT 'METH_' || CAST(sample_key AS VARCHAR) AS PPCG_Meth_Sample_ID, sample_submitter_id AS Meth_Local_Sample_ID,
         regexp_replace(sample_submitter_id, '(?:-[0-9]+)$', '') AS local_donor_id
  FROM s WHERE sample_type = 'Primary Tumor' AND priority = '2-HIGH'),
j AS (
  SELECT meth.PPCG_Meth_Sample_ID, meth.Meth_Local_Sample_ID, meth.local_donor_id, clin.nation, clin.balance,
         clin.segment, clin.status
  FROM meth LEFT JOIN clin ON meth.local_donor_id IS NOT DISTINCT FROM clin.local_donor_id)
SELECT CAST(row_number() OVER (ORDER BY Meth_Local_Sample_ID, PPCG_Meth_Sample_ID, local_donor_id, nation, balance,
                               segment, status) AS BIGINT) AS row_index, *
FROM j"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_sentinels"] = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       NULLIF(o_orderpriority, {SENT}) AS o_orderpriority FROM orders"""
    q["drop_all_null_columns"] = q["clean_sentinels"]
    q["count_all_null_rows"] = f"""
SELECT count(*) FILTER (WHERE o_orderpriority = {SENT} AND o_orderstatus = 'P') AS n_all_null FROM orders"""
    q["catalog_clean"] = _catalog_sql()
    q["shared_keys_full_join"] = f"""
WITH l AS (
  SELECT CASE WHEN o_orderpriority = {SENT} AND o_orderstatus = 'P' THEN NULL
              WHEN o_orderpriority = '5-LOW' THEN -o_orderkey ELSE o_orderkey END AS order_id,
         o_custkey, o_orderstatus AS status
  FROM orders),
r AS (
  SELECT l_orderkey AS order_id, l_linenumber, l_partkey, l_suppkey, l_linestatus AS status
  FROM lineitem)
SELECT COALESCE(l.order_id, r.order_id) AS order_id, l.o_custkey, l.status AS status_orders,
       r.l_linenumber, r.l_partkey, r.l_suppkey, r.status AS status_lineitem
FROM l FULL OUTER JOIN r ON l.order_id IS NOT DISTINCT FROM r.order_id"""
    q["join_all_fold"] = """
WITH c AS (SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN -c_custkey ELSE c_custkey END AS cust_id, c_name FROM customer),
o AS (SELECT CASE WHEN o_orderstatus = 'P' THEN -o_custkey ELSE o_custkey END AS cust_id, count(*) AS n,
             max(o_totalprice) AS top FROM orders GROUP BY 1),
e AS (SELECT user_id AS cust_id, count(*) AS n, max(value) AS top FROM events GROUP BY user_id),
co AS (SELECT COALESCE(c.cust_id, o.cust_id) AS cust_id, c.c_name, o.n AS n_orders, o.top AS top_orders
       FROM c FULL OUTER JOIN o ON c.cust_id IS NOT DISTINCT FROM o.cust_id)
SELECT COALESCE(co.cust_id, e.cust_id) AS cust_id, co.c_name, co.n_orders, co.top_orders, e.n AS n_events,
       e.top AS top_events
FROM co FULL OUTER JOIN e ON co.cust_id IS NOT DISTINCT FROM e.cust_id"""
    q["natural_inner"] = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id IS NOT DISTINCT FROM l.doc_id"""
    q["natural_left"] = q["natural_inner"].replace("JOIN labels", "LEFT JOIN labels")
    q["join_renamed_key"] = """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""
    q["join_renamed_key_left"] = """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, c.c_name
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c ON o.o_custkey IS NOT DISTINCT FROM c.c_custkey"""
    q["semi_cohort"] = f"""
WITH x AS ({LINEITEM_WITH_CASE})
SELECT * FROM x WHERE EXISTS (SELECT 1 FROM ({COHORT}) c WHERE c.id IS NOT DISTINCT FROM x.cust_id)"""
    q["anti_cohort"] = q["semi_cohort"].replace("WHERE EXISTS", "WHERE NOT EXISTS")
    q["derived_key_membership"] = """
SELECT c_custkey, c_name,
       CASE WHEN substr(c_name, 1, 17) IN (SELECT substr(c_name, 1, 17) FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
            THEN 'MATCH' END AS flag
FROM customer WHERE c_mktsegment = 'BUILDING'"""
    q["derived_key_anti"] = """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM customer e WHERE e.c_acctbal < 0 AND e.c_mktsegment = 'BUILDING'
                  AND left(e.c_name, length(e.c_name) - 1) = left(c.c_name, length(c.c_name) - 1))"""
    q["match_any_pattern"] = """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^red') OR regexp_matches(p_name, '^blue')"""
    q["match_any_regex_set"] = """
WITH l AS (
  SELECT p_partkey, concat_ws(' ', p_name, p_brand, p_type, lpad(CAST(p_partkey AS VARCHAR), 7, '0')) AS label, p_size, p_name, p_brand, p_type,
         lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS k FROM part
), p AS (
  SELECT CASE p_partkey % 4 WHEN 0 THEN '^' || p_name || '.*' || k || '$' WHEN 1 THEN p_brand || ' [A-Z]+ ' || k
              WHEN 2 THEN k || '$|^no such part|' || p_type || ' ' || k
              ELSE p_type || '( |-)0+' || CAST(p_partkey AS VARCHAR) || '$' END AS pattern
  FROM l WHERE p_size <= 25
)
SELECT p_partkey, label FROM l WHERE EXISTS (SELECT 1 FROM p WHERE regexp_matches(l.label, p.pattern))"""
    q["match_any_prefix"] = """
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM customer p WHERE p.c_acctbal > 9000
              AND starts_with(c.c_name, left(p.c_name, length(p.c_name) - 1)))"""
    q["filter_suffix_regex"] = "SELECT c_custkey, c_name FROM customer WHERE regexp_matches(c_name, '7$')"
    q["id_union"] = f"""
{COHORT}
UNION ALL
SELECT DISTINCT user_id AS id FROM events"""
    q["id_difference"] = """
SELECT c_custkey AS id FROM customer c WHERE c_acctbal > 5000 AND NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderpriority = '1-URGENT'
  AND o.o_custkey IS NOT DISTINCT FROM c.c_custkey)"""
    q["group_count"] = "SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus"
    q["two_level_count"] = """
SELECT o_orderstatus, count(*) AS n FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders) GROUP BY o_orderstatus"""
    q["pair_count"] = """
SELECT o_custkey, o_orderstatus, CAST(count(*) AS DOUBLE) / 2 AS n FROM orders GROUP BY o_custkey, o_orderstatus"""
    q["freq_table_no_null"] = f"""
SELECT o_orderpriority, count(*) AS n FROM ({ORDERS_NULLED}) WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority"""
    q["unique_with_null"] = f"SELECT DISTINCT o_orderpriority FROM ({ORDERS_NULLED})"
    q["n_unique_with_null"] = f"""
SELECT CAST(count(DISTINCT o_orderpriority) + max(CASE WHEN o_orderpriority IS NULL THEN 1 ELSE 0 END) AS BIGINT)
       AS n_unique FROM ({ORDERS_NULLED})"""
    q["keep_first"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1"""
    q["having_sorted"] = """
SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 70 ORDER BY n DESC, user_id"""
    q["find_replicates"] = """
SELECT sha256(text) AS text_sha256, count(*) AS n, min(doc_id) AS first_doc_id
FROM documents GROUP BY sha256(text) HAVING count(*) >= 2"""
    q["drop_replicates"] = """
SELECT doc_id, lang, source, n_chars
FROM (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1"""
    q["reconcile_counts"] = f"""
SELECT 'status_parts_vs_total' AS check_name, count(*) AS expected,
       count(*) FILTER (WHERE o_orderstatus = 'F') + count(*) FILTER (WHERE o_orderstatus = 'O')
       + count(*) FILTER (WHERE o_orderstatus = 'P') AS actual FROM orders
UNION ALL
SELECT 'priority_known_plus_missing', count(*),
       count(NULLIF(o_orderpriority, {SENT})) + count(*) FILTER (WHERE o_orderpriority = {SENT}) FROM orders
UNION ALL
SELECT 'urgent_vs_high', count(*) FILTER (WHERE o_orderpriority = '1-URGENT'),
       count(*) FILTER (WHERE o_orderpriority = '2-HIGH') FROM orders"""
    q["reconcile_counts"] = f"SELECT *, expected IS NOT DISTINCT FROM actual AS ok FROM ({q['reconcile_counts']})"
    q["profile_columns"] = _profile_sql()
    q["pivot_counts"] = f"""
SELECT o_custkey, NULLIF(BEN, 0) AS BEN, NULLIF(MET, 0) AS MET, NULLIF(TUM, 0) AS TUM FROM ({STATUS_COUNTS})"""
    q["pivot_counts_fill0"] = f"SELECT o_custkey, BEN, MET, TUM FROM ({STATUS_COUNTS})"
    q["pivot_rowsum"] = f"""
SELECT o_custkey, BEN, MET, TUM, TUM + BEN + MET AS tot FROM ({STATUS_COUNTS}) ORDER BY tot DESC, o_custkey"""
    q["pivot_two_values"] = """
WITH f AS (
  SELECT conv_id, role, turn, text FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) AS rn
    FROM conversations) WHERE rn = 1)
SELECT conv_id,
       min(text) FILTER (WHERE role = 'assistant') AS text_assistant,
       min(text) FILTER (WHERE role = 'system') AS text_system,
       min(text) FILTER (WHERE role = 'user') AS text_user,
       min(turn) FILTER (WHERE role = 'assistant') AS turn_assistant,
       min(turn) FILTER (WHERE role = 'system') AS turn_system,
       min(turn) FILTER (WHERE role = 'user') AS turn_user
FROM f GROUP BY conv_id"""
    q["pivot_attribute_wide"] = """
SELECT l.doc_id, d.lang, l.quality, l.toxic FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""
    q["cohort_wide"] = f"""
SELECT o.o_custkey, c.c_name,
       NULLIF(count(*) FILTER (WHERE o_orderpriority = '1-URGENT'), 0) AS "1-URGENT",
       NULLIF(count(*) FILTER (WHERE o_orderpriority = '2-HIGH'), 0) AS "2-HIGH",
       NULLIF(count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM'), 0) AS "3-MEDIUM",
       NULLIF(count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED'), 0) AS "4-NOT SPECIFIED",
       NULLIF(count(*) FILTER (WHERE o_orderpriority = '5-LOW'), 0) AS "5-LOW"
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE EXISTS (SELECT 1 FROM ({COHORT}) k WHERE k.id IS NOT DISTINCT FROM o.o_custkey)
GROUP BY o.o_custkey, c.c_name"""
    q["recode_passthrough"] = f"""
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'high' WHEN o_orderpriority = '2-HIGH' THEN 'high'
            WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority_recoded
FROM ({ORDERS_NULLED})"""
    q["case_when_map"] = f"""
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN 'BEN' WHEN o_orderstatus = 'O' THEN 'TUM'
            WHEN o_orderstatus = 'P' THEN 'MET' END AS sample_type
FROM ({ORDERS_NULLED})"""
    q["if_else_null"] = f"""
SELECT o_orderkey,
       CASE WHEN o_orderpriority IS NULL THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'urgent'
            ELSE 'routine' END AS urgency
FROM ({ORDERS_NULLED})"""
    q["coalesce_registry"] = """
SELECT d.doc_id, COALESCE(r.donor_id, 'NEW_' || CAST(d.doc_id AS VARCHAR)) AS donor_id, r.donor_id AS reg_donor_id
FROM documents d LEFT JOIN (
  SELECT doc_id, 'REG_' || lpad(CAST(doc_id AS VARCHAR), 6, '0') AS donor_id FROM labels) r
ON d.doc_id IS NOT DISTINCT FROM r.doc_id"""
    q["dense_code"] = """
SELECT c_custkey, c_name, 'NEW_' || CAST(dense_rank() OVER (ORDER BY c_name) AS VARCHAR) AS donor_code
FROM customer"""
    q["across_string_codes"] = """
SELECT p_partkey,
       CAST(dense_rank() OVER (ORDER BY p_name) AS BIGINT) AS p_name_code,
       CAST(dense_rank() OVER (ORDER BY p_brand) AS BIGINT) AS p_brand_code,
       CAST(dense_rank() OVER (ORDER BY p_type) AS BIGINT) AS p_type_code,
       p_size, p_retailprice
FROM part"""
    q["across_columns_long"] = """
SELECT p_partkey,
       CAST(dense_rank() OVER (ORDER BY p_name) AS BIGINT) AS p_name_code,
       CAST(dense_rank() OVER (ORDER BY p_brand) AS BIGINT) AS p_brand_code,
       CAST(dense_rank() OVER (ORDER BY p_type) AS BIGINT) AS p_type_code,
       CAST(dense_rank() OVER (ORDER BY p_size) AS BIGINT) AS p_size_code,
       CAST(dense_rank() OVER (ORDER BY p_retailprice) AS BIGINT) AS p_retailprice_code
FROM part"""
    q["barcode_parts"] = """
SELECT c_custkey, substr(c_name, 1, 12) AS case_part, substr(c_name, 1, 15) AS sample_part,
       substr(c_name, 10, 9) AS serial FROM customer"""
    q["strip_suffix"] = """
SELECT c_custkey, left(c_name, length(c_name) - 1) AS no_last, regexp_replace(c_name, '.{4}$', '') AS no_last4,
       regexp_replace(c_name, '0', '') AS first_zero_removed FROM customer"""
    q["last_two"] = """
SELECT c_custkey, right(c_name, 2) AS last_two, NULLIF(regexp_extract(c_name, '[5-9]{2}$'), '') AS hi_pair
FROM customer"""
    q["path_rewrite"] = """
WITH p AS (SELECT page_id, '/data/mirror/' || regexp_replace(url, '^[a-z]+://', '') AS path FROM pages)
SELECT page_id, path, regexp_replace(path, '\\.html$', '.cached.html') AS html_path,
       regexp_replace(path, '.example', '_x.example', 'g') AS quirk_path FROM p"""
    q["json_props"] = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"
    scaffold = {n: f"CAST(NULL AS VARCHAR) AS {n}" for n in WGS_TEMPLATE_NAMES}
    scaffold["Country"] = "'USA' AS Country"
    scaffold["Local_Sample_ID"] = "CAST(o_orderkey AS VARCHAR) AS Local_Sample_ID"
    q["scaffold_template"] = (
        "SELECT " + ", ".join(scaffold[n] for n in WGS_TEMPLATE_NAMES)
        + " FROM orders"
    )
    q["prefix_lower_relocate"] = """
SELECT c_custkey AS cust_c_custkey, c_acctbal AS cust_c_acctbal, c_name AS cust_c_name FROM customer"""
    q["annotate_match"] = """
WITH rna AS (
  SELECT l.l_orderkey, o.o_custkey AS rna_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_returnflag = 'R')
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey IN (SELECT l_orderkey FROM rna) THEN 'MATCHED'
            WHEN o_custkey IN (SELECT rna_custkey FROM rna) THEN 'DISTANT' END AS rna_annot
FROM orders"""
    q["manifest"] = _manifest_sql()
    q["wgs_table"] = _wgs_sql()
    q["rna_table"] = _rna_sql()
    q["assay_table"] = _assay_sql()
    q["clinical_dictionary"] = _clinical_sql()
    q["donors_by_attribute"] = f"""
WITH s AS ({SAMPLES}),
clin AS (
  SELECT c.c_custkey AS case_id, c.c_name AS case_submitter_id, n.n_name AS race
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE EXISTS (SELECT 1 FROM ({COHORT}) k WHERE k.id IS NOT DISTINCT FROM c.c_custkey)),
ds AS (
  SELECT sample_submitter_id, regexp_replace(sample_submitter_id, '(?:-[0-9]+)$', '') AS case_submitter_id
  FROM s WHERE priority = '1-URGENT'),
j AS (
  SELECT clin.case_id, clin.case_submitter_id, clin.race, ds.sample_submitter_id
  FROM clin JOIN ds ON clin.case_submitter_id IS NOT DISTINCT FROM ds.case_submitter_id)
SELECT case_id, case_submitter_id, race, sample_submitter_id FROM (
  SELECT *, row_number() OVER (PARTITION BY case_submitter_id ORDER BY sample_submitter_id, case_id, race) AS rn
  FROM j) WHERE rn = 1 AND race = 'NATION_7'"""
    q["biospecimen_flat"] = """
WITH a AS (SELECT l_orderkey AS sample_id, l_linenumber, l_partkey, l_suppkey, l_returnflag AS analyte_type_id,
                  l_linestatus AS status FROM lineitem),
s AS (SELECT o_orderkey AS sample_id, o_custkey AS case_id, o_orderstatus AS status FROM orders),
c AS (SELECT c_custkey AS case_id, c_name AS case_submitter_id, c_mktsegment AS segment FROM customer),
f AS (SELECT COALESCE(a.sample_id, s.sample_id) AS sample_id, a.l_linenumber, a.l_partkey, a.l_suppkey,
             a.analyte_type_id, a.status AS status_analyte, s.case_id, s.status AS status_sample
      FROM a FULL OUTER JOIN s ON a.sample_id IS NOT DISTINCT FROM s.sample_id)
SELECT f.sample_id, f.l_linenumber, f.l_partkey, f.l_suppkey,
       CASE f.analyte_type_id WHEN 'R' THEN 'RNA' WHEN 'A' THEN 'DNA' WHEN 'N' THEN 'Total RNA'
            ELSE f.analyte_type_id END AS analyte_type_id,
       f.status_analyte, COALESCE(f.case_id, c.case_id) AS case_id, f.status_sample, c.case_submitter_id, c.segment
FROM f FULL OUTER JOIN c ON f.case_id IS NOT DISTINCT FROM c.case_id"""
    q["drop_replicates_suffix"] = """
WITH c AS (SELECT c_custkey, c_name, left(c_name, length(c_name) - 1) AS k FROM customer),
reps AS (SELECT k FROM c GROUP BY k HAVING count(*) > 1)
SELECT c_custkey, c_name FROM c
WHERE NOT (k IN (SELECT k FROM reps) AND regexp_matches(c_name, '[5-9]$'))"""
    q["drop_replicates_exclude"] = """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_orderpriority = '5-LOW' AND b.o_orderstatus = 'P'
                  AND b.o_orderkey IS NOT DISTINCT FROM o.o_orderkey)"""
    q["row_index"] = """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       CAST(row_number() OVER (ORDER BY strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) AS BIGINT) AS row_index
FROM orders"""
    q["top_priorities"] = f"""
WITH long AS (
  SELECT 'o_orderpriority' AS "column", o_orderpriority AS value FROM ({ORDERS_NULLED})
  UNION ALL
  SELECT 'o_orderstatus', o_orderstatus FROM ({ORDERS_NULLED})),
counts AS (SELECT "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY "column", value)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS BIGINT) AS rank FROM counts)
WHERE rank <= 3"""
    q["registry_unique_join"] = """
SELECT d.doc_id, d.source, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id IS NOT DISTINCT FROM l.doc_id"""
    q["center_codes"] = f"""
WITH s AS ({SAMPLES})
SELECT DISTINCT right(concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
                                CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR)), 2) AS center
FROM lineitem l JOIN s ON l.l_orderkey = s.sample_key
WHERE l.l_returnflag = 'R'
  AND EXISTS (SELECT 1 FROM ({COHORT}) c WHERE c.id IS NOT DISTINCT FROM s.case_id)"""
    q["technical_replicates"] = """
SELECT DISTINCT o_custkey FROM (
  SELECT o_custkey, o_orderstatus, CAST(count(*) AS DOUBLE) / 2 AS n FROM orders GROUP BY o_custkey, o_orderstatus)
WHERE n = 2"""
    q["donor_extra_sample"] = f"""
WITH s AS ({SAMPLES}),
extra AS (SELECT case_submitter_id, count(*) AS n FROM s WHERE priority = '1-URGENT'
          GROUP BY case_submitter_id HAVING count(*) > 1)
SELECT * FROM extra WHERE NOT EXISTS (
  SELECT 1 FROM s m WHERE m.priority = '2-HIGH' AND m.sample_type = 'Metastatic'
  AND regexp_replace(m.sample_submitter_id, '(?:-[0-9]+)$', '') IS NOT DISTINCT FROM extra.case_submitter_id)"""
    q["replicate_rule"] = f"""
WITH s AS ({SAMPLES}), k AS (
  SELECT left(sample_submitter_id, length(sample_submitter_id) - 1) AS sample_id FROM s GROUP BY 1 HAVING count(*) > 1)
SELECT case_submitter_id, sample_submitter_id, sample_type FROM s
WHERE NOT (right(sample_submitter_id, 1) BETWEEN '5' AND '9'
           AND EXISTS (SELECT 1 FROM k WHERE starts_with(s.sample_submitter_id, k.sample_id)))"""
    q["derived_key_exclusion"] = f"""
WITH s AS (SELECT *, left(sample_submitter_id, length(sample_submitter_id) - 1) AS vial_free FROM ({SAMPLES}))
SELECT sample_submitter_id, sample_type,
       CASE WHEN vial_free IN (SELECT vial_free FROM s WHERE priority = '1-URGENT') THEN 'MATCH' END AS matching
FROM s WHERE vial_free NOT IN (SELECT vial_free FROM s WHERE priority = '5-LOW')"""
    q["tsv_round_trip"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, NULLIF(o_orderpriority, {SENT}) AS o_orderpriority FROM orders"""
    q["csv_round_trip"] = q["tsv_round_trip"]
    q["csv_index_round_trip"] = """
SELECT CAST(row_number() OVER (ORDER BY c_name, c_mktsegment) AS VARCHAR) AS row_index, c_name, c_mktsegment FROM customer"""
    q["orders_types_guessed"] = "SELECT * FROM orders"
    q["lineitem_types_guessed"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_discount, l_returnflag, CAST(l_shipdate AS DATE) AS ship_day,
       l_tax > 0 AS taxed, lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS part_code, CASE WHEN l_linenumber > 1 THEN l_suppkey END AS supplier
FROM lineitem"""
    q["tables_round_trip"] = """
SELECT o_orderkey, o_orderstatus, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey"""
    q["catalog_round_trip"] = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS name, (SELECT count(*) FROM {t}) AS n_rows, CAST(count(*) AS INT) AS n_columns FROM (DESCRIBE SELECT * FROM {t})"
        for t in ("customer", "orders", "supplier")
    )
    q["commented_tsv"] = "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders"
    q["json_array_round_trip"] = "SELECT o_orderkey, o_orderpriority FROM orders"
    q["json_array_by_ranges"] = """
SELECT o_orderkey, o_orderpriority || CASE WHEN o_orderkey % 5 = 0 THEN ' "}, {\\"a\\": [' ELSE '' END AS note,
       CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS custkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS status FROM orders"""
    q["literal_id_set"] = f"""
SELECT o_orderkey, o_orderstatus, NULLIF(o_orderpriority, {SENT}) AS o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '5-LOW', {SENT})"""
    q["concat_with_na"] = f"""
SELECT o_orderkey, o_orderstatus || '/' || CASE WHEN o_orderpriority = {SENT} THEN 'NA' ELSE o_orderpriority END AS label FROM orders"""
    q["conform_template"] = f"""
SELECT NULLIF(o_orderpriority, {SENT}) AS o_orderpriority, CAST(NULL AS VARCHAR) AS "Country",
       CAST(o_orderkey AS VARCHAR) AS o_orderkey, TRY_CAST(o_orderstatus AS INT) AS o_orderstatus FROM orders"""
    q["catalog_names"] = "\nUNION ALL\n".join(
        f"""SELECT '{t}' AS "table", CAST({i + 1} AS INT) AS position, '{x}' AS "column", count(*) AS n_rows, count({x}) AS n_values FROM {t}"""
        for t, xs in (
            ("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
            ("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]),
        )
        for i, x in enumerate(xs)
    )
    q["match_four_levels"] = """
WITH r AS (SELECT *, strftime(l_shipdate, '%Y-%m') AS m FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 40),
l AS (SELECT *, strftime(l_shipdate, '%Y-%m') AS m FROM lineitem WHERE l_returnflag <> 'R')
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN EXISTS (SELECT 1 FROM r WHERE r.l_orderkey = l.l_orderkey AND r.l_partkey = l.l_partkey) THEN 'ALIQUOT'
            WHEN EXISTS (SELECT 1 FROM r WHERE r.l_orderkey = l.l_orderkey) THEN 'SAMPLE'
            WHEN EXISTS (SELECT 1 FROM r WHERE r.l_partkey = l.l_partkey AND r.l_suppkey = l.l_suppkey) THEN 'DONOR'
            WHEN EXISTS (SELECT 1 FROM r WHERE r.l_partkey = l.l_partkey AND r.m = l.m) THEN 'SITE' END AS level
FROM l"""
    checked = f"""
SELECT o_orderkey, o_orderstatus, NULLIF(o_orderpriority, {SENT}) AS o_orderpriority,
       CASE WHEN o_orderstatus = 'P' THEN 'P' ELSE '' END || o_orderkey AS batch FROM orders"""
    fits = "coalesce(regexp_full_match(o_orderpriority, '[1-3]-[A-Z ]+'), FALSE)"
    q["template_conforming"] = f"""
SELECT o_orderkey, o_orderstatus, o_orderpriority, TRY_CAST(batch AS BIGINT) AS batch, CAST(NULL AS VARCHAR) AS "Country" FROM ({checked})
WHERE o_orderstatus IN ('F', 'O') AND {fits} AND TRY_CAST(batch AS BIGINT) IS NOT NULL"""
    q["template_problems"] = f"""
WITH c AS ({checked})
SELECT o_orderkey, 'o_orderstatus' AS "column", o_orderstatus AS value, 'allowed' AS rule FROM c WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority, 'required' FROM c WHERE o_orderpriority IS NULL
UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority, 'pattern' FROM c WHERE o_orderpriority IS NOT NULL AND NOT {fits}
UNION ALL SELECT o_orderkey, 'batch', batch, 'type' FROM c WHERE TRY_CAST(batch AS BIGINT) IS NULL"""
    q["published_tables"] = """
SELECT o_orderkey, o_orderstatus, count(l_orderkey) AS n_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL"""
    q["published_manifest"] = """
WITH o AS (SELECT count(*) AS n FROM orders), l AS (SELECT count(*) AS n FROM lineitem)
SELECT CAST(v AS BIGINT) AS version, name, n AS rows, CAST(k AS INT) AS n_checks, CASE WHEN k > 0 THEN n END AS expected, CASE WHEN k > 0 THEN n END AS actual
FROM (SELECT 1 AS v, 'orders' AS name, n, 0 AS k FROM o UNION ALL SELECT 1, 'lines', n, 0 FROM l
      UNION ALL SELECT 2, 'orders', n, 1 FROM o UNION ALL SELECT 2, 'lines', n, 0 FROM l)"""
    q["stable_codes"] = """
WITH v AS (SELECT c_name, bool_or(c_mktsegment = 'BUILDING') AS early FROM customer GROUP BY c_name),
k AS (SELECT c_name, row_number() OVER (ORDER BY early DESC, c_name) AS code FROM v)
SELECT c_custkey, code FROM customer JOIN k USING (c_name)"""
    q["profile_merged_years"] = """
WITH t AS (SELECT CAST(year(l_shipdate) AS INT) AS year, l_quantity, CASE WHEN l_discount > 0 THEN l_extendedprice END AS price, l_returnflag FROM lineitem),
s AS (
  SELECT year, 'l_quantity' AS "column", count(*) AS n, count(l_quantity) AS k, avg(l_quantity) AS a, stddev_samp(l_quantity) AS s,
         min(l_quantity) AS lo, max(l_quantity) AS hi, TRUE AS num FROM t GROUP BY year
  UNION ALL
  SELECT year, 'price', count(*), count(price), avg(price), stddev_samp(price), min(price), max(price), count(price) > 0 FROM t GROUP BY year
  UNION ALL
  SELECT year, 'l_returnflag', count(*), count(l_returnflag), NULL, NULL, NULL, NULL, FALSE FROM t GROUP BY year)
SELECT year, "column", metric, round(value, 4) AS value FROM (
  SELECT year, "column", 'n_missing' AS metric, CAST(n - k AS DOUBLE) AS value FROM s
  UNION ALL SELECT year, "column", 'complete_rate', 1.0::DOUBLE - CAST(n - k AS DOUBLE) / n FROM s
  UNION ALL SELECT year, "column", 'mean', a FROM s WHERE num
  UNION ALL SELECT year, "column", 'sd', s FROM s WHERE num
  UNION ALL SELECT year, "column", 'p0', lo FROM s WHERE num
  UNION ALL SELECT year, "column", 'p100', hi FROM s WHERE num)"""
    seen = "SELECT *, row_number() OVER () AS pos FROM lineitem"  # rows as they stand in the file
    q["stable_sort"] = f"""
SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER (ORDER BY l_shipdate, pos) AS place FROM ({seen})"""
    q["pivot_first_seen"] = f"""
SELECT CAST(row_number() OVER (ORDER BY min(pos)) AS INT) AS place, strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n
FROM ({seen}) GROUP BY strftime(l_shipdate, '%Y-%m')"""
    q["sorted_positions"] = "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders"
    parts = []
    for x in ("l_quantity", "l_linenumber"):
        parts.append(f"""
SELECT '{x}' AS "column", CAST(b AS INT) AS bin,
       (SELECT count(*) FROM lineitem WHERE least(CASE WHEN hi > lo THEN floor(({x} - lo) * 8 / (hi - lo)) ELSE 0 END, 7) + 1 = b) AS n
FROM (SELECT min(CAST({x} AS DOUBLE)) AS lo, max(CAST({x} AS DOUBLE)) AS hi FROM lineitem), unnest(range(1, 9)) AS t(b)""")
    q["profile_histogram"] = "\nUNION ALL\n".join(parts)
    q["join_all_found_keys"] = """
WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS k, count(*) AS n FROM orders GROUP BY 1),
e AS (SELECT CAST(user_id AS VARCHAR) AS k, count(*) AS n FROM events GROUP BY 1),
c AS (SELECT CAST(c_custkey AS VARCHAR) AS k, c_name FROM customer),
u AS (SELECT k FROM o UNION SELECT k FROM e UNION SELECT k FROM c)
SELECT u.k AS cust_id, c_name, o.n AS n_orders, e.n AS n_events
FROM u LEFT JOIN c ON u.k = c.k LEFT JOIN o ON u.k = o.k LEFT JOIN e ON u.k = e.k"""
    return q
