"""Table sinks. Parquet by default; CSV with a header as an option.

Output is written by every task in parallel (no ``coalesce(1)``).  CSV writes
NULL as empty by default; ``null_value="NA"`` matches the original text files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), null_value: str | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
        if null_value is not None:
            writer = writer.option("nullValue", null_value)
        writer.csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        writer.format(fmt).save(path)
