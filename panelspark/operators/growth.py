"""Positional lag, growth rates and absolute changes over period series.

Lag is positional: ``lag(x, 4)`` is the value four rows back in period order, not
"the same quarter last year", so a missing quarter shifts it (as in the published
tables).

Two scopes:

* ``series`` (default): one window per series, ``partitionBy(series)``.  A series
  holds one row per period, so a window group is bounded by the calendar.
* ``global``: series are concatenated in (series, period) order and the lag runs
  across series boundaries, reproducing tables built after ``ungroup()``.  A plain
  ``Window.orderBy`` would move everything into one task; instead rows are dealt to
  ranges of that order (bounds from a sample, fixed before the rows move), each range gives
  its last rows to the ranges after it, and one window per range makes the lags.  Rows
  move once, and no index over all rows is made.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.missing import growth_rate
from panelspark.session import ensure_checkpoint_dir

GIDX = "_gidx"
DEFAULT_BLOCK_ROWS = 1 << 16
SAMPLE_PER_RANGE = 30


def _order_cols(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def with_global_index(df: DataFrame, order: Sequence[str], name: str = GIDX,
                      partitions: int | None = None) -> DataFrame:
    """Add a contiguous 0-based row index following ``order`` (NULLs last).

    The range-partitioned, sorted frame is checkpointed to the session's reliable
    checkpoint folder first: range bounds come from sampling, so without it a task
    re-run after an executor loss could see different partitions.  The input is
    meant to be an aggregate (one row per series and period), not raw facts.  The
    per-partition count table has one row per partition (bounded by ``partitions``)
    and is broadcast.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _order_cols(order)
    # The range bounds are sampled by a job of their own; keep the input cached so
    # sampling and the checkpoint write compute it once.
    source = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ordered = source.repartitionByRange(n, *keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    finally:
        source.unpersist()
    tagged = (ordered.withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.col("_pos"))
            .drop("_pid", "_pos", "_off"))


def lag_values(df: DataFrame, lags: Mapping[str, tuple[str, int]], series: Sequence[str],
               order: Sequence[str], scope: str = "series",
               block_rows: int = DEFAULT_BLOCK_ROWS, restart: Sequence[str] = ()) -> DataFrame:
    """Add columns ``out = lag(src, n)`` for each ``out -> (src, n)``.

    ``scope="series"`` lags within each series; ``scope="global"`` lags over the
    series concatenated in (series, order) order.  With ``restart`` the
    concatenation starts again at each value of those columns (several
    independent concatenations share one global index: rows are ordered by
    (restart, series, order) and a lag reaching into another restart group is NULL).
    """
    series, order, restart = list(series), list(order), list(restart)
    if scope == "series":
        w = Window.partitionBy(*restart, *series).orderBy(*_order_cols(order))
        return df.withColumns({out: F.lag(src, n).over(w) for out, (src, n) in lags.items()})
    if scope != "global":
        raise ValueError(f"scope must be 'series' or 'global', got {scope!r}")
    ensure_checkpoint_dir(df.sparkSession)
    keys, df = restart + series + order, df.checkpoint()
    n = df.count()
    if n <= block_rows:         # one range: nothing to hand on
        both = df.withColumns({"_pid": F.spark_partition_id() * 0, "_halo": F.lit(False)})
    else:
        rows = with_ranges(df, keys, block_rows, n)
        both = rows.withColumn("_halo", F.lit(False)).unionByName(_tails(rows, keys, max(n for _, n in lags.values())))
    if restart:
        both = both.withColumn("_grp", F.struct(*restart))
    w = Window.partitionBy("_pid").orderBy(F.desc("_halo"), *_order_cols(keys))
    cols = {}
    for o, (src, n) in lags.items():
        lagged = F.lag(src, n).over(w)
        if restart:
            lagged = F.when(F.lag("_grp", n).over(w).eqNullSafe(F.col("_grp")), lagged)
        cols[o] = lagged
    return both.withColumns(cols).where(~F.col("_halo")).drop("_pid", "_halo", *(["_grp"] if restart else []))


def with_ranges(df: DataFrame, order: Sequence[str], range_rows: int = DEFAULT_BLOCK_ROWS, n: int | None = None) -> DataFrame:
    """Adds ``_pid``, the number of the row's range in ``order`` (NULLs last): ranges of about ``range_rows`` rows, at least two.

    The bounds are keys of a sample (about ``SAMPLE_PER_RANGE`` keys a range, chosen by their hash, so every task and every
    retry sees the same), checkpointed as one row.  A row finds its range in two steps, among every
    s-th bound and then among the s bounds there, s being about the square root of their number.  ``df`` should be a checkpoint or a table: it is read more than once.
    """
    key = F.struct(*[c for name in order for c in (F.col(name).isNull(), F.col(name))])
    n = df.count() if n is None else n
    ranges = max(2, -(-n // range_rows))
    chosen = F.pmod(F.xxhash64(*order, F.lit(11)), F.lit(max(1, n // (SAMPLE_PER_RANGE * ranges)))) == 0
    step = max(1, math.isqrt(ranges))
    sample = df.where(chosen).select(key.alias("k")).agg(F.sort_array(F.collect_list("k")).alias("k"))
    size = F.size("k")
    place = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.floor(size * i / ranges).cast("int") + 1)
    bounds = sample.select(F.when(size > 0, F.transform(place, lambda i: F.get("k", i - 1))).alias("all"))
    every = F.filter("all", lambda x, i: i % step == step - 1)
    found = F.struct(F.col("all"), every.alias("some"))
    held = df.withColumns({"_b": bounds.select(found.alias("b")).checkpoint().scalar(), "_k": key})
    block = F.size(F.filter("_b.some", lambda b: b <= F.col("_k")))
    inside = F.size(F.filter(F.slice("_b.all", F.col("_blk") * step + 1, step), lambda b: b <= F.col("_k")))
    return held.withColumn("_blk", block).withColumn("_pid", F.col("_blk") * step + inside).drop("_b", "_k", "_blk")


def _tails(rows: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """For every range, the n rows before it (of as many ranges before as they take), marked ``_halo``.

    Only each range's last n rows move; which range they go to follows from one row per range.
    """
    down = [F.col(c).desc_nulls_first() for c in order]
    last = (rows.withColumn("_back", F.row_number().over(Window.partitionBy("_pid").orderBy(*down)))
            .where(F.col("_back") <= n))
    ahead = Window.orderBy("_pid")
    ranges = (last.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
              .select("_pid", "_n", F.row_number().over(ahead).alias("_d"), F.sum("_n").over(ahead).alias("_upto")))
    own = (last.join(F.broadcast(ranges), "_pid")
           .withColumns({"_at": F.col("_upto") - F.col("_back"), "_to": F.explode(F.sequence(F.col("_d") + 1, F.col("_d") + n))})
           .drop("_pid", "_n", "_d", "_upto", "_back"))
    goal = ranges.select("_pid", F.col("_d").alias("_to"), (F.col("_upto") - F.col("_n")).alias("_before"))
    return (own.join(F.broadcast(goal), "_to").where(F.col("_before") - F.col("_at") <= n)
            .drop("_to", "_at", "_before").withColumn("_halo", F.lit(True)))


def growth(df: DataFrame, value: str, series: Sequence[str], order: Sequence[str],
           rates: Mapping[str, int] | None = None, changes: Mapping[str, int] | None = None,
           scope: str = "series", zero_base: str = "ieee", restart: Sequence[str] = ()) -> DataFrame:
    """Add growth rates ``(x - lag(x, n)) / lag(x, n)`` and absolute changes ``x - lag(x, n)``.

    ``rates`` and ``changes`` map output column -> lag n.  The first n rows of a
    series (or of the whole table, for global scope) are NULL.  ``restart`` (global
    scope) starts the concatenation again at each value of those columns.
    """
    rates, changes = dict(rates or {}), dict(changes or {})
    ns = sorted(set(rates.values()) | set(changes.values()))
    prev = {f"_prev{n}": (value, n) for n in ns}
    out = lag_values(df, prev, series, order, scope, restart=restart)
    cols = {}
    for name, n in rates.items():
        cols[name] = growth_rate(F.col(value), F.col(f"_prev{n}"), zero_base)
    for name, n in changes.items():
        cols[name] = F.col(value) - F.col(f"_prev{n}")
    return out.withColumns(cols).drop(*prev)
