"""DataFrame -> DataFrame operators."""

from metaweave.operators.aggregates import (
    count_all_null_rows,
    count_groups,
    distinct_values,
    drop_replicates,
    find_replicates,
    freq_table,
    group_count,
    having_count,
    n_unique,
    pair_count,
    row_sum,
)
from metaweave.operators.annotate import annotate_levels, annotate_match, attach_registry
from metaweave.operators.clean import (
    DEFAULT_SENTINELS,
    all_null_columns,
    clean_catalog,
    clean_frame,
    drop_all_null_columns,
    replace_sentinels,
)
from metaweave.operators.dictionary import apply_dictionary, recode_columns
from metaweave.operators.ids import dense_code, dense_codes, with_row_index
from metaweave.operators.joins import (
    check_unique,
    flag_membership,
    full_join_na,
    join_all_na,
    join_na,
    join_on,
    match_any,
    natural_join,
    restrict_to,
    shared_keys,
)
from metaweave.operators.position import first_appearance, stable_sort_index, with_position
from metaweave.operators.quality import long_values, histogram, profile, reconcile, top_values
from metaweave.operators.reshape import keep_first, pivot_wider, unpivot_longer
from metaweave.operators.schema import (
    add_constants,
    apply_by_type,
    c,
    catalog_columns,
    conform,
    drop_positions,
    lower_names,
    prefix_names,
    relocate,
    rename,
    select_positions,
    select_range,
)
from metaweave.operators.sketches import merge_profiles, profile_parts
from metaweave.operators.template import CheckedRows, TemplateField, check_template

__all__ = [name for name in dir() if not name.startswith("_")]
