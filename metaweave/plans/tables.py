"""Reusable table builders (the compositions behind the larger driver queries)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaweave.functions.strings import rewrite_path
from metaweave.operators.joins import natural_join
from metaweave.operators.schema import relocate, rename

# The consortium registry columns and the pipeline manifest header.
REGISTRY_COLUMNS = ["PPCG_Donor_ID", "Sample_Type", "PPCG_Sample_ID", "Is_Normal", "Is_Normal_for_Donor",
                    "Local_Sample_ID"]
MANIFEST_COLUMNS = ["Donor_ID", "Tissue_ID", "is_normal", "is_normal_for_donor", "Sample_ID", "relative_file_path"]


def build_manifest(files: DataFrame, registry: DataFrame, country: str | None, path_prefix: str,
                   old_ext: str = ".bam", new_ext: str = "_unmapped.bam", country_column: str = "Country") -> DataFrame:
    """Pipeline manifest: one row per file of a registered sample.

    ``files`` has ``file_name`` and ``sample_barcode``; ``registry`` has the
    ``REGISTRY_COLUMNS`` (and ``Country`` when ``country`` is given). Files are
    joined to the registry on the sample id, paths are prefixed and their extension
    swapped, and the columns are renamed to the manifest header.
    """
    reg = registry
    if country is not None:
        reg = reg.filter(F.col(country_column) == country)
    reg = reg.select(*REGISTRY_COLUMNS)
    tab = rename(files.select("file_name", "sample_barcode"),
                 {"sample_barcode": "Local_Sample_ID", "file_name": "relative_file_path"})
    tab = natural_join(tab, reg)
    tab = relocate(tab, "relative_file_path", after="Is_Normal_for_Donor")
    tab = tab.withColumn("relative_file_path",
                         rewrite_path("relative_file_path", prefix=path_prefix, old_suffix=old_ext, new_suffix=new_ext))
    tab = tab.drop("Local_Sample_ID")
    tab = rename(tab, {"PPCG_Donor_ID": "Donor_ID", "Sample_Type": "Tissue_ID", "Is_Normal": "is_normal",
                       "Is_Normal_for_Donor": "is_normal_for_donor", "PPCG_Sample_ID": "Sample_ID"})
    return relocate(tab, "Sample_ID", before="relative_file_path")
