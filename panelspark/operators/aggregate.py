"""Grouped sums per period, with detail and total rows from one pass.

All aggregates are NA-safe sums (``sum_skip_missing``); Spark's partial/final hash
aggregation combines map-side, so a hot key costs one row per map task in the
shuffle, not one row per input row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.missing import sum_skip_missing
from panelspark.operators.exact import exact_sums

TOTAL = "Total"
IS_TOTAL = "_is_total"


def _sums(measures: Mapping[str, str], exact_scale: int | None):
    return [sum_skip_missing(src, exact_scale).alias(out) for out, src in measures.items()]


def sum_by_period(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str],
                  exact_scale: int | str | None = None) -> DataFrame:
    """``group_by(keys) %>% summarise(out = sum(src, na.rm=TRUE))``, one row per key.

    ``exact_scale="any"`` sums doubles of any size exactly and rounds once (``exact_sums``).
    """
    if exact_scale == "any":
        return exact_sums(df, keys, measures)
    return df.groupBy(*keys).agg(*_sums(measures, exact_scale))


def with_totals(df: DataFrame, dim: str, period: Sequence[str], measures: Mapping[str, str],
                outer: Sequence[str] = (), total_label: str = TOTAL, exact_scale: int | None = None,
                keep_flag: bool = False) -> DataFrame:
    """Detail rows per (outer, dim, period) plus total rows per (outer, period), one scan.

    Implemented as GROUPING SETS; ``grouping(dim)`` (not ``dim IS NULL``) tells a total
    from a NULL dimension.  Total rows carry ``total_label`` in ``dim``.  With
    ``keep_flag`` a boolean ``_is_total`` column is kept for later windows.
    """
    outer, period = list(outer), list(period)
    sets = [outer + [dim] + period, outer + period]
    agg = df.groupingSets(sets, *outer, dim, *period).agg(
        *_sums(measures, exact_scale), (F.grouping(dim) == 1).alias(IS_TOTAL))
    agg = agg.withColumn(dim, F.when(F.col(IS_TOTAL), F.lit(total_label)).otherwise(F.col(dim)))
    return agg if keep_flag else agg.drop(IS_TOTAL)


def detail_plus_total(df: DataFrame, dim: str, period: Sequence[str], measures: Mapping[str, str],
                      total_label: str = TOTAL, exact_scale: int | None = None) -> DataFrame:
    """Detail rows per (dim, period) and total rows per period, columns in that order, one scan."""
    out = with_totals(df, dim, period, measures, total_label=total_label, exact_scale=exact_scale)
    return out.select(dim, *period, *measures)


def rollup_period(df: DataFrame, keys: Sequence[str], fine: Sequence[str], coarse: Sequence[str],
                  measures: Mapping[str, str], exact_scale: int | None = None) -> DataFrame:
    """Sum to (keys, fine) first, then re-aggregate to (keys, coarse), e.g. months -> years.

    ``n_fine`` counts the fine periods present in each coarse period.
    """
    fine_tbl = sum_by_period(df, [*keys, *fine], measures, exact_scale)
    return fine_tbl.groupBy(*keys, *coarse).agg(
        *[sum_skip_missing(out, exact_scale).alias(out) for out in measures],
        F.count(F.lit(1)).alias("n_fine"))
