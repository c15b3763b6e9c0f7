"""Operator 8: SimHash near-duplicates by a segment-popcount embedding.

Fingerprint: a bit is 1 if it is set in over half of the 64-bit hashes of the text's word
shingles.  Two fingerprints link when they differ in at most ``max_bits`` bits.

Embedding: the 64 bits are cut into 32 segments of two bits, and a fingerprint becomes the
point of its segments' bit counts (0, 1 or 2).  The Manhattan distance of two points is a
lower bound of the number of differing bits.  A point is kept as one 64-bit number in which
every segment's count is written in unary, so that distance is the bit count of an xor.

Grid range join: the 32 coordinates are dealt into ``BLOCKS`` blocks.  Two points within
``max_bits`` differ in at most that many blocks, so they share a grid cell, that is a choice of
``BLOCKS - max_bits`` blocks with their coordinates.  Fingerprints in the same cell are
compared by Manhattan distance, then bit by bit.

A cell of more than ``CELL_PAIRS`` fingerprints (a large group of near copies) is not
paired out.  Its fingerprints are dealt to all points of Hamming space one bit away: two
fingerprints share such a point exactly when they differ in at most two bits, and a point has
at most 65 neighbours.  The links of a point form a star.  So the work on a group grows with
its size, not the square, and no link is lost.

Results for odd input: null, empty and blank texts have fingerprint zero and link like any
other; equal fingerprints link; a component's id is its smallest id, nulls left out (null if
it has only null ids); repeated rows come out as often; other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components

SHINGLE_WORDS, MAX_BITS = 3, 2
BLOCKS, CELL_PAIRS, SALTS = 6, 64, 8
LOW_BITS = 0x5555555555555555
HASHES_AT_ONCE = 1 << 16


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    tokens = text.encode().lower().split() if text else []     # bytes: A-Z and the six ASCII spaces only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = list(accumulate(len(t) + 1 for t in tokens))        # each counts the space after it
    starts = [0, *ends[:len(tokens) - words]]
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), HASHES_AT_ONCE):
        some = starts[at:at + HASHES_AT_ONCE]
        last = ends[at + words - 1:at + words - 1 + len(some)]
        hashes = np.array([digest(joined[a:b - 1], 42) for a, b in zip(some, last)], dtype="<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in range(64) if 2 * set_bits[i] > len(starts)))


def fingerprints(words: int):
    """Column function: text -> fingerprint as a signed long."""
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint(t, words)) for t in texts], dtype="int64")
    return run


def embedded(fp: Column) -> Column:
    """The 32 bit counts of a fingerprint, each in unary in its own two bits."""
    low, shifted = F.lit(LOW_BITS), F.shiftrightunsigned(fp, 1)
    either, both = (fp.bitwiseOR(shifted)).bitwiseAND(low), (fp.bitwiseAND(shifted)).bitwiseAND(low)
    return either.bitwiseOR(F.shiftleft(both, 1))


def cell_masks(max_bits: int, blocks: int = BLOCKS) -> list[int]:
    """Bit masks of the coordinate choices that name a grid cell."""
    cut = [round(32 * i / blocks) for i in range(blocks + 1)]
    masks = [sum(3 << (2 * s) for s in range(cut[i], cut[i + 1])) for i in range(blocks)]
    return [_signed(sum(masks[i] for i in chosen)) for chosen in combinations(range(blocks), blocks - max_bits)]


def link_edges(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column ``fp``); their components are exact."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    masks = F.array(*[F.struct(F.lit(i).alias("choice"), F.lit(m).alias("mask")) for i, m in enumerate(cell_masks(max_bits))])
    entries = (fps.select("fp", embedded(F.col("fp")).alias("point")).select("fp", "point", F.explode(masks).alias("m"))
               .select("fp", "point", F.col("m.choice").alias("choice"), F.col("point").bitwiseAND(F.col("m.mask")).alias("cell")))
    sizes = (entries.groupBy("choice", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))      # deals a crowded cell over tasks
    shared = (entries.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int"))
              .join(sizes, ["choice", "cell", "salt"]).drop("salt").checkpoint())        # those not alone in a cell
    few = shared.where(F.col("n") <= CELL_PAIRS)
    a, b = few.select("choice", "cell", F.col("fp").alias("u"), F.col("point").alias("pu")), \
        few.select("choice", "cell", F.col("fp").alias("v"), F.col("point").alias("pv"))
    near = (a.join(b, ["choice", "cell"]).where("u < v")
            .where(F.bit_count(F.col("pu").bitwiseXOR(F.col("pv"))) <= max_bits)       # Manhattan distance: a lower bound
            .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits).select("u", "v"))
    crowd = shared.where(F.col("n") > CELL_PAIRS).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)).cast("long") for i in range(64)])
    if max_bits == 2:
        met = crowd.select("fp", F.explode(flips).alias("bit")).groupBy(F.col("fp").bitwiseXOR(F.col("bit")).alias("at"))
        stars = met.agg(F.array_agg("fp").alias("near")).where(F.size("near") > 1)      # at most 65 by construction
        star_edges = (stars.select(F.array_min("near").alias("u"), F.explode("near").alias("v")).where("u < v"))
    else:       # one bit: the neighbour itself is looked up
        out = crowd.select(F.col("fp").alias("u"), F.explode(flips).alias("bit")).select("u", F.col("u").bitwiseXOR(F.col("bit")).alias("v"))
        star_edges = out.where("u < v").join(crowd.select(F.col("fp").alias("v")), "v", "left_semi").select("u", "v")
        if max_bits == 0:
            star_edges = star_edges.where(F.lit(False))
    return near.union(star_edges)


def _grouped(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows (_id, _hash of the text, fp), and for every fingerprint its component's best row."""
    text = F.col(text_col).cast("string")
    rows = (docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), fingerprints(words)(text).alias("fp"))
            .checkpoint())
    best = F.struct(F.col("_id").isNull().alias("null_id"), F.col("_id").alias("id"), F.col("_hash").alias("hash"))
    fps = rows.groupBy("fp").agg(F.min(best).alias("best"))
    roots = components(link_edges(fps.select("fp"), max_bits))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "best", F.coalesce("root", "fp").alias("root"))
    winners = rooted.groupBy("root").agg(F.min("best").alias("win"))
    return rows, rooted.join(winners, "root").select("fp", "win")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id, fingerprint (16 hex digits) and component_id."""
    rows, named = _grouped(docs, words, max_bits, id_col, text_col)
    return (rows.join(named, "fp")
            .select(F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("win.id").alias("component_id")))


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: one for each group, the smallest id (null ids last)."""
    _, named = _grouped(docs, words, max_bits, id_col, text_col)
    kept = named.select(F.col("win.id").alias("_win_id"), F.col("win.hash").alias("_win_hash")).distinct()
    own = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_own_id"), F.col(text_col).alias("_own_text"),
                      F.xxhash64(F.col(text_col).cast("string")).alias("_own_hash"))
    same = own["_own_id"].eqNullSafe(kept["_win_id"]) & (own["_own_hash"] == kept["_win_hash"])
    first = Window.partitionBy("_own_id", "_own_hash").orderBy("_own_text")     # rows repeated whole: one
    return own.join(kept, same, "left_semi").withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select("_row.*")
