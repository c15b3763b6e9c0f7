"""Missing-value algebra shared by sums, growth rates and backfills.

The published tables treat NULL and NaN alike as "missing" (``is.na`` is true for
both) but keep +/-Inf as a value.  Every operator in this package goes through
these helpers so the rules stay in one place:

* a sum skips missing cells and is 0 when nothing is left;
* a growth rate over a zero base is +Inf, -Inf or NaN (IEEE), never an error;
* a backfill replaces NULL and NaN, but keeps Inf.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

def null_double() -> Column:
    return F.lit(None).cast("double")


def nan() -> Column:
    return F.lit(float("nan"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL for a floating column; other values unchanged."""
    c = _col(c)
    return F.nanvl(c, null_double())


def is_missing(c: Column | str) -> Column:
    """True for NULL or NaN (``is.na`` semantics)."""
    c = _col(c)
    return c.isNull() | F.isnan(c)


def sum_skip_missing(c: Column | str, exact_scale: int | None = None) -> Column:
    """Aggregate: sum ignoring NULL and NaN; an all-missing group gives 0.

    ``exact_scale`` is for values with at most that many decimals (money in
    cents): each value is summed as a whole number of 10^-scale units in a BIGINT
    (an overflow raises, it never wraps), and the total is turned into a double
    once per group via DECIMAL, so the result is the correctly rounded exact sum,
    whatever the order partial sums arrive in.  Values must be finite; a value that is
    no whole number of units (more decimals than ``exact_scale``) fails the query.
    """
    v = nan_to_null(c)
    if exact_scale is None:
        return F.coalesce(F.sum(v), F.lit(0.0))
    scaled = v * F.lit(float(10 ** exact_scale))
    off = F.abs(scaled - F.rint(scaled)) > F.greatest(F.lit(1e-6), F.abs(scaled) * F.lit(1e-14))
    msg = F.concat(F.lit(f"more than {exact_scale} decimals in an exact sum: "), v.cast("string"))
    units = F.when(off, F.raise_error(msg).cast("long")).otherwise(F.rint(scaled).cast("long"))
    exact = F.sum(units).cast(DecimalType(38, 0)) / F.lit(10 ** exact_scale)
    return F.coalesce(exact.cast("double"), F.lit(0.0))


def ieee_divide(num: Column | str, den: Column | str, zero_base: str = "ieee") -> Column:
    """num / den with IEEE results on a zero denominator.

    ``zero_base="ieee"``: x/0 is +Inf, -x/0 is -Inf, 0/0 and NaN/0 are NaN.
    ``zero_base="null"``: any zero denominator gives NULL.
    Spark's ANSI ``/`` throws on zero, so the zero case is spelled out; NaN is
    tested before the sign because Spark orders NaN above every number.
    """
    num, den = _col(num), _col(den)
    if zero_base == "null":
        return F.when(den == 0, null_double()).otherwise(num / den)
    if zero_base != "ieee":
        raise ValueError(f"zero_base must be 'ieee' or 'null', got {zero_base!r}")
    on_zero = (F.when(F.isnan(num), nan())
               .when(num > 0, F.lit(float("inf")))
               .when(num < 0, F.lit(float("-inf")))
               .when(num == 0, nan()))
    return F.when(den == 0, on_zero).otherwise(num / den)


def growth_rate(value: Column | str, base: Column | str, zero_base: str = "ieee") -> Column:
    """(value - base) / base with the zero-base rule of ``ieee_divide``."""
    value, base = _col(value), _col(base)
    return ieee_divide(value - base, base, zero_base)


def backfill(target: Column | str, source: Column | str, numeric: bool = True) -> Column:
    """``if_else(is.na(target), source, target)``.

    For floating columns NaN counts as missing too, Inf does not.
    """
    target, source = _col(target), _col(source)
    if numeric:
        return F.coalesce(nan_to_null(target), source)
    return F.coalesce(target, source)


def if_else(cond: Column, yes: Column, no: Column) -> Column:
    """Typed conditional where a NULL condition gives NULL (not the else branch)."""
    return F.when(cond, yes).when(~cond, no)
