"""Relational operators built on the DataFrame API."""

from quarry.operators.agg import (  # noqa: F401
    best_of,
    biggest_gap,
    count_by,
    count_distinct_with_null,
    count_of_distinct_state,
    distinct_state,
    finish_mean,
    mean_count,
    mean_count_wide,
    mean_of,
    merge_distinct,
    merge_sum_count,
    metrics_table,
    sum_count,
    with_summary_row,
)
from quarry.operators.heavy import frequent_over, frequent_top_k  # noqa: F401
from quarry.operators.lookup import (  # noqa: F401
    LINE_ORDER,
    JoinLayout,
    attach,
    exclude_terms,
    place_of,
    skew_safe_lookup,
    stage_for_join,
    unique_lookup,
)
from quarry.operators.rank import (  # noqa: F401
    attach_rank,
    collect_top_k,
    dense_rank_table,
    top_k_per_group,
)
