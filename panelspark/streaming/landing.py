"""Incremental landing of delimited drops into a parquet table.

The original scripts re-download and re-read whole archives on every run.  Here
new files dropped into a folder are appended to a parquet table exactly once: a
Structured Streaming file source run with ``trigger(availableNow=True)`` processes
what has arrived and stops.  Its progress lives in a checkpoint folder that the caller
names and keeps with the table: a later application that names the same folder goes
on where the last one stopped.  The batch plans then read the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def land_delimited(spark: SparkSession, source_dir: str, schema: StructType, table_dir: str,
                   checkpoint: str, sep: str = "|", partition_by: Sequence[str] = (),
                   max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Append every not-yet-landed file of ``source_dir`` to the parquet table at ``table_dir``.

    ``checkpoint`` must be a stable shared path, the same in every run for one table: the
    table's log and the checkpoint belong together.  Rows keep the file they came from in ``_source``.  Returns the started query;
    call ``awaitTermination()`` to wait for the available files to be processed.
    """
    stream = (spark.readStream.schema(schema).option("sep", sep).option("header", True)
              .option("maxFilesPerTrigger", max_files_per_trigger).csv(source_dir)
              .withColumn("_source", F.col("_metadata.file_name")))
    writer = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
              .outputMode("append").trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(table_dir)
