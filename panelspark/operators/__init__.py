"""DataFrame operators built from Spark's DataFrame API."""

from panelspark.operators.aggregate import (IS_TOTAL, TOTAL, detail_plus_total, rollup_period,
                                            sum_by_period, with_totals)
from panelspark.operators.dictionary import map_distinct
from panelspark.operators.exact import exact_sums
from panelspark.operators.frames import (backfill_columns, checked_broadcast, drop_matching, fits_broadcast,
                                         join_panels, rename_matching, rename_strict, select_prefix,
                                         select_spec, split_column, union_by_name, with_columns_chained)
from panelspark.operators.growth import growth, lag_values, with_global_index
from panelspark.operators.reshape import (cells_to_rows, cut_columns, duplicate_keys, explode_pairs, fill_zero, pivot_cells, pivot_sum, pivot_values,
                                          pivot_wide, row_sum)
from panelspark.operators.skew import hot_keys, lookup_join, merge_keep_left, sized_join, split_join

__all__ = [
    "IS_TOTAL", "TOTAL", "backfill_columns", "cells_to_rows", "checked_broadcast", "cut_columns", "detail_plus_total",
    "drop_matching", "duplicate_keys", "exact_sums", "explode_pairs", "fill_zero", "fits_broadcast", "growth", "hot_keys",
    "join_panels", "lag_values", "lookup_join", "map_distinct", "merge_keep_left", "rename_matching", "pivot_cells", "pivot_sum", "pivot_values",
    "pivot_wide", "rename_strict", "rollup_period", "row_sum", "select_prefix", "select_spec", "sized_join",
    "split_join",
    "split_column", "sum_by_period", "union_by_name", "with_columns_chained", "with_global_index",
    "with_totals",
]
