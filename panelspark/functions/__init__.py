"""Column expressions. Everything here is a built-in Spark expression."""

from panelspark.functions.labels import (int_text, month_label, quarter_end_date, quarter_end_label,
                                         quarter_label, recode, safe_double, safe_int, unify)
from panelspark.functions.missing import (backfill, growth_rate, ieee_divide, if_else, is_missing,
                                          nan_to_null, sum_skip_missing)
from panelspark.functions.text import (extract_first, paste, remove_all, remove_first, sentence_case,
                                       split_piece, substr_between, trim_space)

__all__ = [
    "backfill", "extract_first", "growth_rate", "ieee_divide", "if_else", "int_text", "is_missing",
    "month_label", "nan_to_null", "paste", "quarter_end_date", "quarter_end_label", "quarter_label",
    "recode", "remove_all", "remove_first", "safe_double", "safe_int", "sentence_case", "split_piece",
    "substr_between", "sum_skip_missing", "trim_space", "unify",
]
