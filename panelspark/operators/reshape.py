"""Reshaping: nested arrays to rows, long to wide, zero-fill, row-wise sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.missing import sum_skip_missing
from panelspark.operators.growth import with_global_index
from panelspark.operators.skew import sized_join


def explode_pairs(df: DataFrame, array_col: str, parents: Sequence[str],
                  names: tuple[str, str] = ("V1", "V2")) -> DataFrame:
    """One row per element of a list of pairs, parent fields copied down.

    Rows whose array is NULL or empty vanish.  A short pair gives NULL for the
    missing element (``get`` rather than ``[]``, which throws under ANSI).
    """
    p = F.col("_pair")
    return (df.select(*parents, F.explode(array_col).alias("_pair"))
            .select(*parents, F.get(p, 0).alias(names[0]), F.get(p, 1).alias(names[1])))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations occurring more than once, with their count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


# Up to this many key values a pivot is one conditional aggregation (one shuffle);
# beyond it Spark's own pivot (two aggregations, but compact for wide outputs).
INLINE_PIVOT_VALUES = 64


def pivot_values(df: DataFrame, key: str) -> list:
    """Distinct non-NULL key values, sorted (the column order ``spread`` produces).

    Bounded by ``spark.sql.pivotMaxValues``, as for Spark's own pivot: more values raise.
    ``pivot_wide`` and ``pivot_cells`` take any number.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    vals = [r[0] for r in df.select(key).where(F.col(key).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(vals) > limit:
        raise ValueError(f"more than {limit} distinct values in pivot column {key!r}")
    return sorted(vals)


def pivot_wide(df: DataFrame, key: str, value: str, ids: Sequence[str] | None = None,
               values: Sequence[str] | None = None, strict: bool = True) -> DataFrame:
    """Long to wide (``spread``): one column per key value, absent pairs NULL.

    ``ids`` defaults to every other column.  ``values`` should be declared when
    known (saves the distinct job and fixes the column set); rows whose key is
    NULL make no column.  Without ``strict`` a cell is the first value that is not NULL.  With ``strict`` a repeated (ids, key) pair fails the query
    at run time, as ``spread`` does, instead of silently keeping one value; the
    check rides in the same aggregation.  More values than ``spark.sql.pivotMaxValues`` go through ``pivot_cells``.
    """
    ids = list(ids) if ids is not None else [c for c in df.columns if c not in (key, value)]
    if values is None:
        limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
        if df.select(key).where(F.col(key).isNotNull()).distinct().limit(limit + 1).count() > limit:
            cells, names = pivot_cells(df, key, value, ids, strict)
            return cut_columns(cells, names, ids)
    values = list(values) if values is not None else pivot_values(df, key)
    msg = f"duplicate ({', '.join(ids)}, {key}) pair in pivot"
    if len(values) <= INLINE_PIVOT_VALUES:
        k, v = F.col(key), F.col(value)
        aggs = []
        for val in values:
            hit = k == F.lit(val)
            cell = F.first(F.when(hit, v), ignorenulls=True)
            if strict:
                cell = F.when(F.count(F.when(hit, F.lit(1))) > 1, F.raise_error(F.lit(msg))).otherwise(cell)
            aggs.append(cell.alias(str(val)))
        return df.groupBy(*ids).agg(*aggs)
    pivoted = df.groupBy(*ids).pivot(key, values)
    cell = F.first(value, ignorenulls=True)          # the same cell as in the one-pass form
    if not strict:
        return pivoted.agg(cell)
    wide = pivoted.agg(cell.alias("v"), F.count(F.lit(1)).alias("n"))
    checked = [F.when(F.col(f"`{val}_n`") > 1, F.raise_error(F.lit(msg))).otherwise(F.col(f"`{val}_v`"))
               .alias(str(val)) for val in values]
    return wide.select(*ids, *checked)


def pivot_cells(df: DataFrame, key: str, value: str, ids: Sequence[str], strict: bool = True,
                block: int = INLINE_PIVOT_VALUES) -> tuple[DataFrame, DataFrame]:
    """Long to wide for any number of key values: (cells, names).

    ``names`` numbers the key values in order (key, ``ordinal``); ``cells`` has one row per ids with one array
    ``cells`` whose place ``ordinal`` holds that key's value, NULL where the pair is absent.  The array is made in blocks: one aggregation
    spreads the cells of (ids, block) into ``block`` places, a second one sets an id's blocks in a row; every id has an empty row in each block, so none is looked for.  So no plan has more than ``block`` cell expressions, however
    wide the table gets.  Rows whose key is NULL make no column; with ``strict`` a repeated pair fails the query at run time,
    without it a cell is the first value that is not NULL.  ``cut_columns`` makes columns of the places.
    """
    ids = list(ids)
    keyed = df.where(F.col(key).isNotNull())
    names = with_global_index(keyed.select(key).distinct(), [key], name="ordinal").checkpoint()
    n = names.count()
    rows = sized_join(keyed.select(*ids, key, F.col(value).alias("_v")), names, [key])
    rows = rows.select(*ids, "_v", F.floor(F.col("ordinal") / block).cast("int").alias("_block"), (F.col("ordinal") % block).alias("_place"))
    numbers = keyed.sparkSession.range(-(-n // block)).select(F.col("id").cast("int").alias("_block"))
    empty = keyed.select(*ids).distinct().crossJoin(F.broadcast(numbers)).withColumns({"_v": F.lit(None).cast(df.schema[value].dataType), "_place": F.lit(None).cast("long")})
    rows = rows.unionByName(empty)
    place, msg = F.col("_place"), F.lit(f"duplicate ({', '.join(ids)}, {key}) pair in pivot")
    cells = []
    for i in range(block):
        hit = place == i
        cell = F.first(F.when(hit, F.col("_v")), ignorenulls=True)
        cells.append(F.when(F.count(F.when(hit, F.lit(1))) > 1, F.raise_error(msg)).otherwise(cell) if strict else cell)
    blocks = rows.groupBy(*ids, "_block").agg(F.array(*cells).alias("_cells"))
    every = blocks.groupBy(*ids).agg(F.sort_array(F.collect_list(F.struct("_block", "_cells"))).alias("_blocks"))
    return every.select(*ids, F.slice(F.flatten("_blocks._cells"), 1, n).alias("cells")), names


def cut_columns(cells: DataFrame, names: DataFrame, ids: Sequence[str], start: int = 0, stop: int | None = None) -> DataFrame:
    """Columns ``start`` to ``stop`` (all by default) of ``pivot_cells`` as real columns; only their names reach the driver."""
    wanted = names.where(F.col("ordinal") >= start) if stop is None else names.where((F.col("ordinal") >= start) & (F.col("ordinal") < stop))
    found = sorted((r["ordinal"], r[0]) for r in wanted.select(names.columns[0], "ordinal").collect())
    return cells.select(*ids, *[F.get("cells", F.lit(int(o))).alias(str(k)) for o, k in found])


def cells_to_rows(cells: DataFrame, names: DataFrame, ids: Sequence[str], value: str) -> DataFrame:
    """The long form again: ids, key, value for every cell that is not NULL."""
    rows = cells.select(*ids, F.posexplode("cells").alias("ordinal", value)).where(F.col(value).isNotNull())
    return sized_join(rows.withColumn("ordinal", F.col("ordinal").cast("long")), names, ["ordinal"]).drop("ordinal")


def pivot_sum(df: DataFrame, key: str, value: str, ids: Sequence[str], values: Sequence[str] | None = None,
              exact_scale: int | None = None) -> DataFrame:
    """Grouped NA-safe sums spread wide in one aggregation (``summarise`` then ``spread``).

    A (ids, key) group that exists but holds only missing values sums to 0; a
    group that does not exist stays NULL (fill it with ``fill_zero`` if wanted).
    """
    values = list(values) if values is not None else pivot_values(df, key)
    if len(values) > INLINE_PIVOT_VALUES:
        long = df.groupBy(*ids, key).agg(sum_skip_missing(value, exact_scale).alias(value))
        return pivot_wide(long, key, value, ids=ids, values=values, strict=False)
    k = F.col(key)
    aggs = []
    for val in values:
        hit = k == F.lit(val)
        total = sum_skip_missing(F.when(hit, F.col(value)), exact_scale)
        aggs.append(F.when(F.count(F.when(hit, F.lit(1))) > 0, total).alias(str(val)))
    return df.groupBy(*ids).agg(*aggs)


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace NULL (and NaN) by 0 in the given value columns only."""
    return df.fillna(0, subset=list(cols))


def row_sum(cols: Sequence[str]) -> Column:
    """Plain row-wise sum; NULL if any term is NULL (fill first)."""
    out = F.col(cols[0])
    for c in cols[1:]:
        out = out + F.col(c)
    return out
