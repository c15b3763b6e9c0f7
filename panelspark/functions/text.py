"""Text helpers, all built-in expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAX_LEN = 2147483647


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentence_case(c: Column | str) -> Column:
    """First character upper case, the rest lower case ('le flore' -> 'Le flore').

    Not ``initcap``, which would capitalise every word.
    """
    c = _col(c)
    return F.concat(F.upper(c.substr(1, 1)), F.lower(c.substr(2, _MAX_LEN)))


def substr_between(c: Column | str, start: int, end: int) -> Column:
    """Characters start..end, 1-based and inclusive; short input gives a short result."""
    c = _col(c)
    return c.substr(start, end - start + 1)


def remove_first(c: Column | str, pattern: str) -> Column:
    """Remove only the leftmost match of ``pattern`` (Spark replaces all by default).

    The lazy prefix ``[\\s\\S]*?`` stops at the first position where the pattern
    matches; the pattern itself keeps the default meaning of ``.``.
    """
    return F.regexp_replace(_col(c), f"^([\\s\\S]*?)(?:{pattern})", "$1")


def remove_all(c: Column | str, pattern: str) -> Column:
    """Remove every match of ``pattern``; leftmost alternative wins at each position."""
    return F.regexp_replace(_col(c), pattern, "")


def trim_space(c: Column | str) -> Column:
    """Trim white space (not only blanks) on both sides."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def extract_first(c: Column | str, pattern: str) -> Column:
    """First match of ``pattern``; NULL when nothing matches."""
    return F.regexp_substr(_col(c), F.lit(pattern))


def split_piece(c: Column | str, sep_regex: str, index: int) -> Column:
    """Piece ``index`` (1-based) after splitting on a regex; NULL if there are fewer pieces."""
    return F.try_element_at(F.split(_col(c), sep_regex, -1), F.lit(index))


def paste(sep: str, *parts: Column | str, na_text: bool = False) -> Column:
    """Join parts with ``sep``.

    Default: a NULL part makes the whole key NULL.  ``na_text=True`` renders NULL
    as the text ``NA`` (what the original scripts wrote).
    """
    cols = [_col(p).cast("string") for p in parts]
    if na_text:
        cols = [F.coalesce(c, F.lit("NA")) for c in cols]
    out = []
    for i, c in enumerate(cols):
        if i:
            out.append(F.lit(sep))
        out.append(c)
    return F.concat(*out)
