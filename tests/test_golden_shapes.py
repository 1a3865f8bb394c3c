"""End-to-end shapes of the two reproducible outputs, on synthetic barcodes and files."""

import glob
import json
import os

from pyspark.sql import functions as F

from metaweave.functions import case_when, drop_suffix_regex
from metaweave.operators import join_on
from metaweave.plans.queries import WGS_TEMPLATE
from metaweave.plans.tables import MANIFEST_COLUMNS, build_manifest
from metaweave.sources import id_table, null_scaffold, read_csv, read_json_array, read_tsv, write_csv, write_tsv


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return path


def _registry_csv(path):
    header = ("Country,Donor_UUID,PPCG_Donor_ID,PPCG_Sample_ID,Local_Sample_ID,Local_Donor_ID,Sanger_UUID,EO_UUID,"
              "Sample_UUID,Matched_Normal_PPCG_Sample_ID,Is_Normal,Is_Normal_for_Donor,Sample_Type,Progether_ID")
    rows = []
    kinds = [("N", "N", "Tumour"), ("Y", "Y", "Germline"), ("Y", "N", "Benign")]
    for i in range(12):
        n1, n2, kind = kinds[i % 3]
        country = "USA" if i < 10 else "UK"
        rows.append(f"{country},,D{i // 3:03d},S{i:03d},PRJ-AA-{i // 3:04d}-0{i % 3}A,PRJ-AA-{i // 3:04d},,,,,"
                    f"{n1},{n2},{kind},NA")
    return _write(path, header + "\n" + "\n".join(rows))


def test_manifest_golden_shape(spark, tmpdir_path):
    objs = [{"project_id": "P", "submitter_id": f"x{i}", "file_name": f"f{i}.bam", "object_id": f"o{i}",
             "data_type": "Aligned Reads", "file_size": 150_000_000_000 + i, "analysis_type": None,
             "sample_barcode": f"PRJ-AA-{i // 3:04d}-0{i % 3}A", "specimen_barcode": None} for i in range(12)]
    files = read_json_array(spark, _write(os.path.join(tmpdir_path, "metadata.json"), json.dumps(objs, indent=1)))
    registry = read_csv(spark, _registry_csv(os.path.join(tmpdir_path, "wgs_ids.csv")))
    manifest = build_manifest(files, registry, country="USA", path_prefix="/omics/data/wgs/")
    assert manifest.columns == MANIFEST_COLUMNS
    out = os.path.join(tmpdir_path, "manifest")
    write_tsv(manifest, out, single_file=True)
    text = "".join(open(p).read() for p in glob.glob(os.path.join(out, "part-*")))
    lines = text.strip().split("\n")
    assert lines[0] == "\t".join(MANIFEST_COLUMNS)
    assert len(lines) == 1 + 10  # the two UK samples are left out
    back = read_tsv(spark, out)
    counts = {r.Tissue_ID: r["count"] for r in back.groupBy("Tissue_ID").count().collect()}
    assert counts == {"Tumour": 4, "Germline": 3, "Benign": 3}
    assert back.filter(~F.col("relative_file_path").rlike(r"^/omics/data/wgs/f[0-9]+_unmapped\.bam$")).count() == 0


def test_wgs_table_golden_shape(spark, tmpdir_path):
    specimens = id_table(spark, [f"PRJ-AA-{i:04d}-{t}" for i in range(4) for t in ("01A", "10A")])
    samples = spark.createDataFrame(
        [(f"PRJ-AA-{i:04d}-{t}", kind) for i in range(4) for t, kind in (("01A", "Primary Tumor"),
                                                                        ("10A", "Blood Derived Normal"))],
        "sample_submitter_id string, sample_type string")
    wgs_files = spark.createDataFrame([(f"PRJ-AA-{i:04d}-{t}", f"DO{i}", f"SA{i}{t}", f"obj{i}{t}")
                                       for i in range(4) for t in ("01A", "10A")],
                                      "source_sample_id string, Archive_Donor string, Sample_ID string, Object_ID string")
    tab = null_scaffold(specimens, WGS_TEMPLATE, id_column="Local_Sample_ID", fill={"Country": "USA"})
    tab = tab.withColumn("Local_Donor_ID", drop_suffix_regex("Local_Sample_ID", "-.{3}"))
    tab = join_on(tab, samples.withColumnRenamed("sample_type", "biospecimen_type"),
                  {"Local_Sample_ID": "sample_submitter_id"})
    st = F.col("biospecimen_type")
    tab = tab.withColumn("Sample_Type", case_when((st == "Primary Tumor", st),
                                                  (st == "Blood Derived Normal", "Blood Derived Normal (Germline)")))
    tab = join_on(tab.drop("biospecimen_type"), wgs_files, {"Local_Sample_ID": "source_sample_id"})
    tab = tab.withColumn("Sample_UUID", F.col("Object_ID")).drop("Object_ID")
    assert tab.columns == [n for n, _ in WGS_TEMPLATE] + ["Archive_Donor", "Sample_ID"]
    out = os.path.join(tmpdir_path, "wgs")
    write_csv(tab, out, single_file=True)
    back = read_csv(spark, out)
    assert back.count() == 8
    # typed-NULL template columns come back as NULL (written as NA), never as the text "null"
    assert back.filter(F.col("Donor_UUID").isNotNull()).count() == 0
    assert back.filter(F.col("Local_Donor_ID").rlike("^PRJ-AA-[0-9]{4}$")).count() == 8
