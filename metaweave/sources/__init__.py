"""Readers and writers (delimited, JSON, Parquet checkpoints)."""

from metaweave.sources.json_ranges import read_json_array_ranges
from metaweave.sources.published import Check, CheckFailed, latest_version, manifest, publish, read_all_versions, read_published
from metaweave.sources.readers import (
    as_schema,
    id_table,
    list_table_files,
    null_scaffold,
    read_catalog,
    read_checkpoint,
    read_commented_tsv,
    read_csv,
    read_json_array,
    read_json_lines,
    read_tsv,
    sanitize_names,
)
from metaweave.sources.types import guess_types, typed
from metaweave.sources.writers import save_tables, write_csv, write_csv_indexed, write_tsv

__all__ = [
    "Check",
    "CheckFailed",
    "as_schema",
    "guess_types",
    "id_table",
    "latest_version",
    "list_table_files",
    "manifest",
    "null_scaffold",
    "publish",
    "read_all_versions",
    "read_catalog",
    "read_checkpoint",
    "read_commented_tsv",
    "read_csv",
    "read_json_array",
    "read_json_array_ranges",
    "read_json_lines",
    "read_published",
    "read_tsv",
    "sanitize_names",
    "save_tables",
    "typed",
    "write_csv",
    "write_csv_indexed",
    "write_tsv",
]
