"""Operator 3: exact duplicates by a tree-merge of sorted digest runs (built-in functions only).

The rows are dealt to ``RADIX ** ROUNDS`` leaf runs by a hash of their place in the scan; a run has its digests, each once, with
the best row seen and the number of rows.  In binomial rounds, runs whose numbers differ in
the lowest digit exchange and merge (``RADIX`` ways at once) into one run: equal
digests keep the best row, counts add up.  A merged run is spread over all tasks by digest,
so no task holds a whole run, not even the last, which covers the corpus.  Each round moves
one entry per run and digest, never a row of the input.

What Spark runs per level: the best row is the smallest of a struct, which a hash aggregate cannot hold, so each level is a sort by (run,
digest, check) and a merge of equal neighbours (``Sort`` and ``SortAggregate``), before the exchange and after it.  The sorted pieces of a run lie in
the tasks' partitions by digest hash; there is no file per run.

Digests are *verified* at every level: the merge key is the SHA-256 of the normalised text
together with its length in bytes and an independent 64-bit hash, so texts that agreed in
the first only would stay apart.

The answer goes back down the same way: the last run's winner joins the leaf runs (at most
``RADIX ** ROUNDS`` entries per digest, however many copies there are), and the leaf entry
joins the rows on (run, digest), so a text with a third of all rows is dealt over all leaf runs.

Results for odd input: null text counts as empty; an empty table gives no rows; among
equally long texts the smallest id stays, null ids last; of rows repeated with the same
winning id, all name that id as ``keep_id`` and exactly one of them is ``kept``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RADIX, ROUNDS = 8, 2
SPACE_CHARS = " \t\n\x0b\x0c\r"     # [\x20\x09-\x0D]


def normalised(text: Column) -> Column:
    """The text without any of the six ASCII white-space characters."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in SPACE_CHARS:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def merge_runs(runs: DataFrame, rounds: int = ROUNDS, radix: int = RADIX) -> DataFrame:
    """Binomial rounds: (run, key.., best, size) of all leaf runs into the one last run."""
    for _ in range(rounds):
        runs = (runs.withColumn("_run", F.floor(F.col("_run") / radix).cast("int"))
                .groupBy("_run", "_digest", "_check").agg(F.min("_best").alias("_best"), F.sum("_size").alias("_size")))
    return runs


def skeleton(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, digest, check value, length, its place in the scan and its leaf run.

    Written once to the checkpoint folder: places must not change when a task runs again.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    place = F.monotonically_increasing_id()
    return (docs.select(F.col(id_col).alias("_id"), F.char_length(text).alias("_chars"), normalised(text).alias("_norm"))
            .select("_id", "_chars", F.sha2("_norm", 256).alias("_digest"),
                    F.struct(F.octet_length("_norm").alias("bytes"), F.xxhash64("_norm").alias("hash")).alias("_check"),
                    place.alias("_row"), F.pmod(F.xxhash64(place), F.lit(RADIX ** ROUNDS)).cast("int").alias("_run"))
            .checkpoint())


def leaf_runs(rows: DataFrame) -> DataFrame:
    best = F.struct((-F.col("_chars")).alias("chars"), F.col("_id").isNull().alias("null_id"),
                    F.col("_id").alias("id"), F.col("_row").alias("row"))
    return rows.groupBy("_run", "_digest", "_check").agg(F.min(best).alias("_best"), F.count(F.lit(1)).alias("_size"))


def group_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id, keep_id, group_size, kept and text_sha256."""
    rows = skeleton(docs, id_col, text_col)
    leaf = leaf_runs(rows)
    last = merge_runs(leaf).select("_digest", "_check", F.col("_best").alias("_win"), F.col("_size").alias("_total"))
    answer = leaf.select("_run", "_digest", "_check").join(last, ["_digest", "_check"])
    return (rows.join(answer, ["_run", "_digest", "_check"])
            .select(F.col("_id").alias(id_col), F.col("_win.id").alias("keep_id"), F.col("_total").alias("group_size"),
                    (F.col("_win.row") == F.col("_row")).alias("kept"), F.col("_digest").alias("text_sha256")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each different text."""
    winners = (merge_runs(leaf_runs(skeleton(docs, id_col, text_col)))
               .select(F.col("_best.id").alias("_win_id"), F.col("_digest").alias("_win_digest"),
                       (-F.col("_best.chars")).alias("_win_chars")))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_own_id"), F.col(text_col).alias("_own_text"),
                      F.sha2(normalised(text), 256).alias("_own_digest"), F.char_length(text).alias("_own_chars"))
    same = (own["_own_id"].eqNullSafe(winners["_win_id"]) & (own["_own_digest"] == winners["_win_digest"])
            & (own["_own_chars"] == winners["_win_chars"]))
    # rows repeated with the winner's id and length: one of them
    first = Window.partitionBy("_own_id", "_own_digest").orderBy("_own_text")
    return own.join(winners, same, "left_semi").withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select("_row.*")
