"""Frame-level operators: joins, renames, column selection, unions, backfills."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from panelspark.functions.missing import backfill
from panelspark.functions.text import split_piece

# Largest lookup we broadcast without a shuffle; beyond it Spark's own join choice applies.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024

# Bytes per value of the fixed-width types when sizing a broadcast.
_WIDTH = {"ByteType": 1, "BooleanType": 1, "ShortType": 2, "IntegerType": 4, "DateType": 4,
          "FloatType": 4, "LongType": 8, "DoubleType": 8, "TimestampType": 8, "TimestampNTZType": 8,
          "DecimalType": 16}


def row_bytes(schema: StructType) -> Column:
    """Bytes of a row: fixed widths, the bytes of texts, and those of anything else as JSON."""
    size = F.lit(8)
    for f in schema.fields:
        c, kind = F.col(f"`{f.name}`"), type(f.dataType).__name__
        if kind in _WIDTH:
            size = size + F.lit(_WIDTH[kind])
        elif kind in ("StringType", "BinaryType"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        else:
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
    return size


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and at most ``max_bytes`` bytes.

    Rows and bytes are summed in every task and only those sums are gathered, so the
    check is one pass over the side, however large; it is made anew each time, since
    a table may have grown.
    """
    n, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df.schema).cast("long"))).first()
    return n <= max_rows and (size or 0) <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    Above the bound the frame is returned unhinted and the join is planned as a
    shuffle join (with AQE able to re-plan it at runtime).
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def rename_strict(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; unlike ``withColumnsRenamed``, a missing column is an error."""
    missing = [old for old in mapping if old not in df.columns]
    if missing:
        raise KeyError(f"cannot rename missing columns: {missing}")
    return df.withColumnsRenamed(dict(mapping))


def select_prefix(df: DataFrame, *prefixes: str, ignore_case: bool = True) -> DataFrame:
    """Keep columns whose name starts with any prefix, in the order of the prefixes."""
    chosen: list[str] = []
    for p in prefixes:
        for c in df.columns:
            hit = c.lower().startswith(p.lower()) if ignore_case else c.startswith(p)
            if hit and c not in chosen:
                chosen.append(c)
    return df.select(*chosen)


def select_spec(df: DataFrame, spec: Sequence[str | tuple[str, str]]) -> DataFrame:
    """Select by a mixed list: plain names, or ("prefix", p) entries, in order."""
    chosen: list[str] = []
    for item in spec:
        if isinstance(item, tuple):
            kind, p = item
            if kind != "prefix":
                raise ValueError(kind)
            names = [c for c in df.columns if c.lower().startswith(p.lower())]
        else:
            if item not in df.columns:
                raise KeyError(item)
            names = [item]
        chosen.extend(n for n in names if n not in chosen)
    return df.select(*chosen)


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Drop columns whose name matches a regex (zero matches drops nothing)."""
    rx = re.compile(pattern)
    return df.drop(*[c for c in df.columns if rx.search(c)])


def rename_matching(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """Rename columns by a regex on their names (zero matches rename nothing; a clash of new names raises)."""
    names = [re.sub(pattern, replacement, c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"renaming {pattern!r} gives one name twice: {names}")
    return df.toDF(*names)


def join_panels(left: DataFrame, right: DataFrame, key: str, drop_right: Sequence[str] = (),
                how: str = "left") -> DataFrame:
    """Join two panels on a composed key; the left side's columns win.

    ``drop_right`` lists right-hand columns that repeat left ones (e.g. the year
    both panels carry).  Any other shared name would be ambiguous, so it raises
    instead of producing suffixed twins.
    """
    right = right.drop(*drop_right)
    clash = [c for c in right.columns if c in left.columns and c != key]
    if clash:
        raise ValueError(f"columns on both sides of the panel join: {clash}")
    return left.join(right, key, how)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; columns absent from a frame are NULL. Keeps duplicates."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def backfill_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """For each target -> source, replace missing target cells with the source.

    Applied in order, so a later backfill sees earlier ones.  NaN counts as missing
    in floating columns.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    batch: dict[str, Column] = {}
    for target, source in mapping.items():
        if source in batch or target in batch:   # depends on an earlier backfill: apply those first
            df, batch = df.withColumns(batch), {}
        numeric = isinstance(types.get(target), (DoubleType, FloatType))
        batch[target] = backfill(target, source, numeric=numeric)
    return df.withColumns(batch) if batch else df


def split_column(df: DataFrame, col: str, into: Sequence[str], sep: str = ",", drop: bool = True) -> DataFrame:
    """Split one text column into several; extra pieces are dropped, missing ones NULL."""
    out = df.withColumns({name: split_piece(col, sep, i + 1) for i, name in enumerate(into)})
    if drop and col not in into:
        out = out.drop(col)
    return out


def with_columns_chained(df: DataFrame, exprs: Iterable[tuple[str, Column]]) -> DataFrame:
    """Add columns one after another, so a later expression can use an earlier one."""
    for name, e in exprs:
        df = df.withColumn(name, e)
    return df
