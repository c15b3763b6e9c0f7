"""panelspark: Spark-native panel tables for regional energy and housing statistics.

Layout:
  functions/  column expressions (missing-value algebra, text, labels)
  operators/  DataFrame operators (aggregation, growth, joins, reshaping)
  sources/    readers for landed files, and sinks
  plans/      the published tables, built from the operators
  streaming/  incremental landing of new files
"""

from panelspark.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
