"""Numbered lines of text files that are read in splits.

A large file is read by many tasks, so no task knows how many lines stand before its own.  One pass counts
the lines of every split; the sums of those counts, file by file, are the splits' offsets (one row per
split); the second pass adds them to each line's place in its split.  Nothing is moved to number a line.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.operators.frames import checked_broadcast
from panelspark.session import ensure_checkpoint_dir


def split_lines(spark: SparkSession, path: str | Sequence[str], sep: str | None = None) -> DataFrame:
    """Lines of the text files at ``path``: file, source (its name), start (byte of the line's split), id (ascending in a split), value."""
    reader = spark.read if sep is None else spark.read.option("lineSep", sep)
    return reader.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("source"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"), "value")


def numbered_lines(spark: SparkSession, path: str | Sequence[str], sep: str | None = None,
                   per_split: Mapping[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines, splits) of the text files at ``path``; ``sep`` ends a line (default: line ends).

    ``lines``: file, source (its name), at (0-based number in its file), value.  ``splits``: file, start (byte),
    before (lines of the file before the split), first (``id`` of its first line), n, and the aggregates ``per_split`` over value and ``id``, which
    numbers a split's lines in ascending order.  ``splits`` is small and written to the checkpoint folder.
    """
    ensure_checkpoint_dir(spark)
    raw = split_lines(spark, path, sep)
    counted = raw.groupBy("file", "start").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"),
                                               *[c.alias(name) for name, c in (per_split or {}).items()])
    ahead = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = counted.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))).checkpoint()
    offsets = checked_broadcast(splits.select("file", "start", (F.col("before") - F.col("first")).alias("_shift")))
    lines = raw.join(offsets, ["file", "start"]).select("file", "source", (F.col("id") + F.col("_shift")).alias("at"), "value")
    return lines, splits
