"""Period labels, number/text casts and value recoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelspark.functions.text import paste


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c: Column | str) -> Column:
    """Text to DOUBLE; unparsable text becomes NULL (ANSI ``cast`` would throw)."""
    return _col(c).try_cast("double")


def safe_int(c: Column | str) -> Column:
    return _col(c).try_cast("int")


def int_text(c: Column | str) -> Column:
    """Whole number as text without a decimal part (2015.0 -> '2015')."""
    return _col(c).cast("int").cast("string")


def quarter_label(year: Column | str, quarter: Column | str) -> Column:
    """'2015-3' (year and quarter, no padding)."""
    return paste("-", int_text(year), int_text(quarter))


def quarter_end_label(year: Column | str, quarter: Column | str) -> Column:
    """'2015-9-01': the first day of the quarter's last month, unpadded."""
    return paste("-", int_text(year), int_text(_col(quarter) * 3), F.lit("01"))


def month_label(year: Column | str, month: Column | str) -> Column:
    """'2015-3-01': the first day of the month, unpadded."""
    return paste("-", int_text(year), int_text(month), F.lit("01"))


def quarter_end_date(year: Column | str, quarter: Column | str) -> Column:
    """A real DATE for the quarter-end-month label (NULL for invalid parts)."""
    return F.try_make_timestamp_ntz(_col(year).cast("int"), (_col(quarter) * 3).cast("int"),
                                    F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast("date")


def recode(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace mapped values; unmapped values (and NULL) pass through unchanged."""
    c = _col(c)
    if not mapping:
        return c
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, c), c)


def unify(c: Column | str, variants: list[str], target: str) -> Column:
    """Several spellings of one value to a single one; NULL stays NULL."""
    c = _col(c)
    return F.when(c.isin(*variants), F.lit(target)).otherwise(c)
