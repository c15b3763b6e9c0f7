"""Costly column functions run once per different value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.frames import fits_broadcast
from panelspark.session import ensure_checkpoint_dir

SALTS = 64


def map_distinct(df: DataFrame, column: str, function: Callable[[str], Column], name: str | None = None) -> DataFrame:
    """``df`` with ``function(column)`` as column ``name`` (default: in place), evaluated once per different value.

    The different values go to the checkpoint folder, so the optimiser cannot merge the function into
    the scan of ``df``, where it would run once per row.  The results are joined back: by broadcast behind a size check, beyond it
    by shuffle with each value copied over salts, so that a value with many rows is dealt over many tasks.
    """
    ensure_checkpoint_dir(df.sparkSession)
    name = name or column
    values = df.select(F.col(column).alias("_value")).distinct().checkpoint()
    results = values.select("_value", function("_value").alias("_result"))
    same = F.col(column).eqNullSafe(F.col("_value"))
    if fits_broadcast(values):
        joined = df.join(F.broadcast(results), same, "left")
    else:
        copies = results.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = df.withColumn("_dealt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
        joined = salted.join(copies, same & (F.col("_dealt") == F.col("_salt")), "left").drop("_dealt", "_salt")
    out = joined.withColumn(name, F.col("_result")).drop("_value", "_result")
    return out.select(*df.columns, *([name] if name not in df.columns else []))
