"""metaweave: harmonise sample and subject metadata with Spark DataFrames.

Sub-packages
------------
sources    readers and writers with one missing-value policy
functions  column expressions (three-valued conditionals, recoding, barcode parts)
operators  DataFrame -> DataFrame building blocks (clean, join, reshape, ids, quality)
plans      the driver-facing queries and the table-building compositions
llm        operators over text corpora (scoring, deduplication, filters, packing, tokens, archives, pages)
"""

__version__ = "0.1.0"
