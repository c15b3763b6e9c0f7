"""Operator 4: shards by extendible hashing (built-in functions only).

Rows are hashed by id.  A directory is indexed by the hash's leading bits; a bucket that holds
more bytes than the limit splits on one bit more, any other stays, until every bucket fits.
A prefix never holds more than its shorter prefix, so a row's bucket is the shortest prefix of
its hash that fits.  The directory is built from byte sums per cell (a prefix some bits
longer than the shards need on average); cells that do not fit even so go on, alone, with
``STEP_BITS`` bits more.  After the ``ID_BITS`` bits of the id come bits of the row's place in
the scan, which part rows of the same id.  One row alone in its bucket stays, whatever its size.

Results for odd input: null or empty text has no bytes; null ids hash like empty text;
repeated ids share a shard until that overflows; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARD_BYTES = 1 << 20
ID_BITS, PLACE_BITS, STEP_BITS = 60, 60, 6
MORE_BITS = 4               # bits of a cell beyond those that shards need on average


def _hash60(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _prefix(depth: Column | int, first: str = "_h", second: str = "_g") -> Column:
    """The leading bits of (id hash, place hash) as text of 0 and 1."""
    bits = F.concat(F.lpad(F.bin(first), ID_BITS, "0"), F.lpad(F.bin(second), PLACE_BITS, "0"))
    return F.substring(bits, F.lit(1), depth if isinstance(depth, Column) else F.lit(depth))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """Buckets (shard, depth, shard_bytes, shard_rows) of rows (_h, _g, bytes)."""
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    deep = ID_BITS + PLACE_BITS
    low, high = 0, min(deep, MORE_BITS + max(0, math.ceil(math.log2(max(1, total / limit)))))
    found, open_rows = None, rows
    while True:
        cells = open_rows.groupBy(_prefix(high).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        levels = (cells.select("*", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
                  .groupBy("depth", F.substring("cell", F.lit(1), F.col("depth")).alias("shard"))
                  .agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows")))
        levels = levels.withColumn("fits", (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1)).checkpoint()
        full = levels.where(~F.col("fits"))
        # a bucket of the directory fits, and the prefix one bit shorter does not
        parent = full.select((F.col("depth") + 1).alias("depth"), F.col("shard").alias("parent"))
        fitting = levels.where("fits").withColumn("parent", F.substring("shard", F.lit(1), F.col("depth") - 1))
        split = fitting.join(parent, ["depth", "parent"], "left_semi")
        roots = fitting.where(F.col("depth") == low) if low == 0 else fitting.limit(0)
        here = split.union(roots.select(split.columns)).select("shard", "depth", "shard_bytes", "shard_rows")
        found = here if found is None else found.union(here)
        left = full.where(F.col("depth") == high).select(F.col("shard").alias("cell"))
        if high >= deep:        # every bit is used: the same row many times over at one place cannot be
            return found.union(full.where(F.col("depth") == high).select(here.columns))
        if left.isEmpty():
            return found
        open_rows = open_rows.withColumn("cell", _prefix(high)).join(left, "cell", "left_semi").drop("cell")
        low, high = high, min(deep, high + STEP_BITS)


def _assigned(rows: DataFrame, limit: int) -> DataFrame:
    """Rows (their columns, bytes, _h, _g) with shard, depth, shard_bytes and shard_rows; ``rows`` must be a checkpoint."""
    buckets = directory(rows.select("bytes", "_h", "_g"), limit).checkpoint()
    depths = sorted(r["depth"] for r in buckets.select("depth").distinct().collect())      # at most ID_BITS + PLACE_BITS
    tried = rows.withColumn("shard", F.explode(F.array(*[_prefix(d) for d in depths]))) if depths else rows.withColumn("shard", F.lit(""))
    return tried.join(buckets, "shard").drop("_h", "_g")


def _placed(docs: DataFrame, id_col: str, text_col: str, *carried: Column) -> DataFrame:
    return docs.select(*carried, F.col(id_col).alias("_id"), F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("bytes"),
                       _hash60(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_h"),
                       _hash60(F.monotonically_increasing_id().cast("string")).alias("_g")).checkpoint()


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id, bytes, shard (its bits), depth, shard_bytes and shard_rows."""
    rows = _assigned(_placed(docs, id_col, text_col), limit)
    return rows.select(F.col("_id").alias(id_col), "bytes", "shard", "depth", "shard_bytes", "shard_rows")


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the rows as Parquet, a folder ``_shard=s<bits>`` for each shard.

    Whole rows are written to the checkpoint folder with their place, so rows of one id are told apart and each is written once.  A column
    named ``_shard`` raises: it would be taken for the folder's.
    """
    if "_shard" in docs.columns:
        raise ValueError("a column is named _shard, as the shards' folders are")
    rows = _assigned(_placed(docs, id_col, text_col, F.struct("*").alias("_row")), limit)
    (rows.select("_row.*", F.concat(F.lit("s"), "shard").alias("_shard")).repartition("_shard")
     .write.partitionBy("_shard").parquet(path))
