"""Queries that land driver tables as files and read them back with the library's readers.

The files are written by Spark to the shared checkpoint folder; their number grows with the table
(``ROWS_PER_FILE``).  Importing this module adds the queries to the catalogue.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.plans.catalogue import register, table
from panelspark.sources import SHEET_COLUMNS, damaged_sheet_rows, publish_table, read_json_matrix, read_published, read_sheet_set

ROWS_PER_FILE = 500_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the session's checkpoints."""
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4()}"


def land_lines(lines: DataFrame, folder: str) -> None:
    """Writes lines (file, part, at, value) as one text file per ``file``, in the order of part and at."""
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (lines.repartition(n, "file").sortWithinPartitions("file", "part", "at").select("file", "value")
     .write.partitionBy("file").text(folder))


def _files(spark: SparkSession, rows: DataFrame) -> int:
    return max(2, -(-rows.count() // ROWS_PER_FILE))


def framed(rows: DataFrame, files: Column, first: list[str], last: list[str]) -> DataFrame:
    """Lines (file, part, at, value) of ``rows`` (at, value), dealt to files, with the same first and last lines in each."""
    body = rows.select(files.alias("file"), F.lit(1).alias("part"), F.col("at").cast("long").alias("at"), "value")
    every = body.select("file").distinct()
    ends = [every.select("file", F.lit(part).alias("part"), F.posexplode(F.array(*map(F.lit, lines))).alias("at", "value")).withColumn("at", F.col("at").cast("long"))
            for part, lines in ((0, first), (2, last)) if lines]
    out = body
    for e in ends:
        out = out.unionByName(e)
    return out


@register("json_matrix_files", r"""
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line, l_returnflag AS flag,
       CASE l_linenumber WHEN 2 THEN 'a ] b' WHEN 3 THEN 'open ["' WHEN 4 THEN ']],[\' WHEN 5 THEN NULL ELSE l_linestatus END AS note, CAST(NULL AS VARCHAR) AS absent
FROM lineitem""")
def q_json_matrix_files(spark, d):
    """Line items as large JSON matrices, read in splits; texts with brackets, quotes and backslashes (SRC-5, SRC-6)."""
    li = table(spark, d, "lineitem")
    note = F.when(F.col("l_linenumber") == 2, "a ] b").when(F.col("l_linenumber") == 3, 'open ["').when(F.col("l_linenumber") == 4, "]],[\\").otherwise(F.col("l_linestatus"))
    cells = F.array(F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_returnflag"),
                    F.when(F.col("l_linenumber") != 5, note), F.lit("second"))
    rows = li.select("l_orderkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("at"), F.concat(F.lit(","), F.to_json(cells)).alias("value"))
    folder = shared_folder(spark, "matrices")
    land_lines(framed(rows, F.concat(F.lit("HousingPhysChar_"), (F.col("l_orderkey") % _files(spark, li)).cast("string")),
                      ['[["order_id","line","flag","note","flag"]'], ["]"]), folder)
    return read_json_matrix(spark, folder, ["order_id", "line", "flag", "note", "absent"]).drop("source")


@register("sheet_files", """
SELECT 'sheet_' || CAST(year(l_shipdate) AS INTEGER) AS sheet,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(year(l_shipdate) AS INTEGER) END AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       l_returnflag AS state, l_linestatus AS typeofproducer, CAST(l_orderkey AS VARCHAR) AS energysource,
       CASE WHEN l_linenumber IN (4, 5) THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS generation
FROM lineitem""")
def q_sheet_files(spark, d):
    """Line items as one sheet per ship year: exactly the title rows go, rows damaged in year and value stay (SRC-4)."""
    return _sheets(spark, d)


@register("sheet_files_report", """
SELECT 'sheet_' || CAST(year(l_shipdate) AS INTEGER) AS sheet, count(*) AS rows, count(*) FILTER (l_linenumber IN (4, 5)) AS damaged
FROM lineitem GROUP BY 1""")
def q_sheet_files_report(spark, d):
    """Rows and damaged rows of every sheet (SRC-4)."""
    return damaged_sheet_rows(_sheets(spark, d))


def _sheets(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    year = F.year("l_shipdate")
    n = F.col("l_linenumber")
    value = F.concat_ws(",", F.when(n == 4, "20x1").otherwise(year.cast("string")), F.month("l_shipdate").cast("string"), F.col("l_returnflag"),
                        F.col("l_linestatus"), F.col("l_orderkey").cast("string"), F.when(n == 4, "n/a").when(n == 5, "").otherwise(n.cast("string")))
    rows = li.select(F.concat(F.lit("sheet_"), year.cast("string")).alias("file"), F.lit(1).alias("part"), (F.col("l_orderkey") * 8 + n).alias("at"), value.alias("value"))
    header = "YEAR,MONTH,STATE,TYPE OF PRODUCER,ENERGY SOURCE,GENERATION"
    titled = ["2001 was the first year", "2001,1,a title, that looks, like data,5", "", "Megawatthours", header]
    sheets = rows.select("file").distinct()
    above = F.when(_even("file"), F.array(*map(F.lit, titled))).otherwise(F.array(F.lit(header)))
    top = sheets.select("file", F.lit(0).alias("part"), F.posexplode(above).alias("at", "value")).withColumn("at", F.col("at").cast("long"))
    folder = shared_folder(spark, "sheets")
    land_lines(rows.unionByName(top), folder)
    names = [r["file"] for r in sheets.where(_even("file")).collect()]             # one per even year
    return read_sheet_set(spark, folder, names=SHEET_COLUMNS, title_rows=dict.fromkeys(names, len(titled) - 1), sheet=F.regexp_extract("file", "file=([^/]*)/", 1))


@register("published_facts", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice, CAST(year(l_shipdate) AS INTEGER) AS yr FROM lineitem""")
def q_published_facts(spark, d):
    """Line items published twice (the second version with other values, then replaced), checked and read back (SNK-1)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice", F.year("l_shipdate").cast("int").alias("yr"))
    folder = shared_folder(spark, "published")
    publish_table(li.withColumn("l_quantity", F.col("l_quantity") * 2), folder, "draft", partition_by=["yr"])
    publish_table(li, folder, "final", partition_by=["yr"])
    publish_table(li.limit(0), folder, "final")               # a retry of a published version changes nothing
    return read_published(spark, folder)


def _even(sheet: str) -> Column:
    return F.regexp_extract(sheet, "[0-9]+$", 0).cast("int") % 2 == 0
