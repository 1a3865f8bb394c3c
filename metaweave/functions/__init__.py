"""Column expressions: null-aware conditionals, recoding and barcode parts."""

from metaweave.functions.nulls import (
    all_null,
    case_when,
    coalesce_ids,
    concat_na,
    if_else,
    is_in_values,
    recode,
    typed_null,
)
from metaweave.functions.strings import (
    detect,
    drop_last,
    drop_suffix_regex,
    extract,
    last_chars,
    rewrite_path,
    str_sub,
    sub_first,
)

__all__ = [
    "all_null",
    "case_when",
    "coalesce_ids",
    "concat_na",
    "if_else",
    "is_in_values",
    "recode",
    "typed_null",
    "detect",
    "drop_last",
    "drop_suffix_regex",
    "extract",
    "last_chars",
    "rewrite_path",
    "str_sub",
    "sub_first",
]
