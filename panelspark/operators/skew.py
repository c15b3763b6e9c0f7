"""Joins with hot keys: found by a counter table of fixed size, joined apart from the rest.

A shuffle join sends all rows of a key to one task, so a key with a third of the rows makes one task
as long as a third of the job.  Here the hot keys of the large side are found first, in one pass over its key columns; their
rows stay where they are and meet the few matching rows of the other side by broadcast (behind a size check; beyond it
those rows are copied over salts), and only the other rows are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.frames import DEFAULT_BROADCAST_ROWS, fits_broadcast

COUNTERS = 4096            # of the table that every task keeps and the tasks' tables are merged into
LEAST_SHARE = 0.002        # twice what a table of that size can be wrong by
SALTS = 64


def hot_keys(df: DataFrame, keys: Sequence[str], share: float | None = None) -> list[int]:
    """Hashes (``xxhash64`` of the key columns) of keys with at least ``share`` of the rows.

    Every task counts into a table of ``COUNTERS`` entries (the frequent-items sketch of Spark's
    ``approx_top_k``); the tables are merged and a row of at most 1 / ``share`` entries reaches the driver.  The default share is a
    shuffle partition's part of the rows, but not under ``LEAST_SHARE``.  A missing key counts as a key; cold
    keys whose hash meets a hot one's are treated alike, which changes no result.
    """
    if share is None:
        share = 1 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(share, LEAST_SHARE)
    most = math.ceil(1 / share)
    top, n = df.agg(F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(most), F.lit(COUNTERS)), F.count(F.lit(1))).first()
    return sorted(r["item"] for r in top or [] if r["count"] >= share * n)


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", share: float | None = None,
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``left.join(right, keys, how)`` (inner or left) whatever share of ``left`` a key holds.

    Rows of a missing key, which one task of a left join would get, are spread like those of any hot key.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', got {how!r}")
    keys = list(keys)
    hot = hot_keys(left, keys, share)
    if not hot:
        return left.join(right, keys, how)
    is_hot = F.xxhash64(*keys).isin(hot)
    few = right.where(is_hot)
    rest = left.where(~is_hot).join(right.where(~is_hot), keys, how)
    if fits_broadcast(few, max_broadcast_rows):
        return left.where(is_hot).join(F.broadcast(few), keys, how).unionByName(rest)
    salted = left.where(is_hot).withColumn("_salt", F.pmod(F.xxhash64(*[c for c in left.columns]), F.lit(SALTS)))
    copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt").unionByName(rest)


def sized_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcasts ``right`` if it passes the size check, else joins by ``split_join`` (other kinds of join: by shuffle)."""
    if how in ("inner", "left", "left_semi", "left_anti") and fits_broadcast(right, max_broadcast_rows):
        return left.join(F.broadcast(right), list(keys), how)
    return split_join(left, right, keys, how) if how in ("inner", "left") else left.join(right, list(keys), how)


def merge_keep_left(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                    max_broadcast_rows: int | None = None) -> DataFrame:
    """Equi-join where, for columns on both sides, the left value wins.

    The right copies of shared non-key columns are dropped before the join so the
    result has no ambiguous duplicates.  With ``max_broadcast_rows`` the right side
    is broadcast when it passes that size check (a medium dimension table).
    Otherwise, and without it, an inner or left join takes the hot keys of the left side apart (``split_join``).
    """
    shared = [c for c in right.columns if c in left.columns and c not in keys]
    right = right.drop(*shared)
    if max_broadcast_rows is not None:
        return sized_join(left, right, keys, how, max_broadcast_rows)
    return split_join(left, right, keys, how) if how in ("inner", "left") else left.join(right, list(keys), how)


def lookup_join(left: DataFrame, lookup: DataFrame, left_key: str, lookup_key: str | None = None,
                how: str = "inner", normalize: str | None = None,
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Enrich ``left`` from a lookup table.

    ``lookup_key`` is renamed to ``left_key`` so only one key column remains.
    ``normalize="lower"`` lower-cases the left key first (the lookup must already be
    lower case).  The lookup is broadcast after a size check; a larger one is joined with the left side's hot
    keys taken apart.
    """
    lookup_key = lookup_key or left_key
    if normalize == "lower":
        left = left.withColumn(left_key, F.lower(F.col(left_key)))
    elif normalize is not None:
        raise ValueError(normalize)
    if lookup_key != left_key:
        lookup = lookup.drop(left_key).withColumnRenamed(lookup_key, left_key)
    shared = [c for c in lookup.columns if c in left.columns and c != left_key]
    lookup = lookup.drop(*shared)
    return sized_join(left, lookup, [left_key], how, max_broadcast_rows)
