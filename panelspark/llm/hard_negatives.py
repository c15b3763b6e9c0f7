"""Operator 13: hard negatives for anchors, by segment summaries.

A vector's components become whole numbers, floor(256 x).  Every vector is cut into 1, 4, 16, ... segments
(down to ``LEAST_SEGMENT`` components), and each segment keeps its mean and its deviation (the length of what is left without the mean).
For two vectors the sum over segments of (length * mean * mean) plus and minus the sum of (deviation * deviation) bounds the inner
product, by Cauchy's inequality.  An anchor's candidates go through the coarse bound first, those that it
cannot settle through the next finer one, and only what is left is scored exactly, in whole numbers.

* Positives: the best ``positives`` other rows of the anchor's label.  A candidate goes when its upper bound is under
  as many lower bounds.
* Negatives: rows of another label with low * positive <= 100 * negative <= high * positive; for each positive the best
  ``negatives`` of them.  A candidate goes when its bounds miss the window, or when enough candidates lie surely inside and above it.

Rows are packed into blocks with their summaries once (checkpointed, so a row keeps its number).  Anchors, in
blocks too, meet every block of rows: one group per (block of anchors, block of rows), each of bounded size; a group gives its
best few per anchor, and the best of those are taken in a window per anchor.  Nothing but block counts reaches the driver.

Results for odd input: rows with a null label, a null vector or a null or non-finite component take no part; vectors of different lengths are not
compared; a null id comes last among ties and is no anchor; repeated rows are rows of their own (never the anchor
itself, but its copies are); components beyond 2^62 count as that, and scores beyond 64 bits as the largest;
an anchor without positives, or whose windows are empty, gives no rows; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS, ANCHORS = 8192, 4096          # rows and anchors per block
LEAST_SEGMENT = 4
SLACK = 4e-6                        # of both lengths: more than the summaries' rounding to 32 bits
LARGEST = (1 << 63) - 1


def levels(dim: int) -> list[np.ndarray]:
    """First components of the segments, coarse to fine."""
    out, n = [], 1
    while n == 1 or dim // n >= LEAST_SEGMENT:
        out.append(np.arange(n) * dim // n)
        n *= 4
    return out


def summaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(means, deviations) of all segments of all levels, one row per vector; the means carry the square root of the segment's length."""
    means, spreads = [], []
    for first in levels(x.shape[1]) if x.shape[1] else []:
        size = np.diff(np.append(first, x.shape[1]))
        mean = np.add.reduceat(x, first, axis=1) / size
        rest = x - np.repeat(mean, size, axis=1)
        means.append(mean * np.sqrt(size))
        spreads.append(np.sqrt(np.add.reduceat(rest * rest, first, axis=1)))
    if not means:
        return np.zeros((len(x), 0)), np.zeros((len(x), 0))
    return np.concatenate(means, axis=1), np.concatenate(spreads, axis=1)


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """floor(256 x) as int64."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x.astype(np.float64) * 256), -(2.0 ** 62), 2.0 ** 62).astype(np.int64)


class Block:
    """Rows of one length: ids, labels, row numbers, whole-number vectors, summaries."""

    def __init__(self, dim: int, ids, known, labels, rows, vectors, means, spreads):
        self.dim, self.ids, self.known, self.labels, self.rows = dim, ids, known, labels, rows
        self.vectors, self.means, self.spreads = vectors, means.astype(np.float64), spreads.astype(np.float64)
        self.exact = vectors.astype(np.float64)
        self.length = np.sqrt((self.exact * self.exact).sum(axis=1))
        self.most = float(np.abs(self.exact).max(initial=0))

    def scores(self, at: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Exact inner products, in doubles where those are exact."""
        bound = self.most * float(np.abs(vector.astype(np.float64)).max(initial=0)) * max(self.dim, 1)
        if bound < 2 ** 53:
            return np.rint(self.exact[at] @ vector.astype(np.float64)).astype(np.int64)
        if bound < 2 ** 56:                     # 100 times a score still fits
            return self.vectors[at] @ vector
        return (self.vectors[at].astype(object) @ vector.astype(object)).reshape(len(at))

    def refine(self, at: np.ndarray, vector: np.ndarray, mean: np.ndarray, spread: np.ndarray, keep: Callable) -> np.ndarray:
        """What is left of the rows ``at``: ``keep(lower, upper bounds)`` tells at each level, coarse to fine, which may stay."""
        length, done = float(np.sqrt((vector.astype(np.float64) ** 2).sum())), 0
        for first in levels(self.dim) if self.dim else []:
            part = slice(done, done + len(first))
            done += len(first)
            middle, reach = self.means[at, part] @ mean[part], self.spreads[at, part] @ spread[part]
            reach = reach + SLACK * self.length[at] * length + 1e-9
            at = at[keep(middle - reach, middle + reach)]
        return at

    def best(self, at: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
        """Places in ``at`` of the best scores; ties by id (null last), then by row."""
        own = np.arange(len(at))
        if len(at) > most and scores.dtype != object:
            own = np.flatnonzero(scores >= np.partition(scores, len(at) - most)[len(at) - most])
        i = at[own]
        order = np.lexsort((self.rows[i], self.ids[i], ~self.known[i], -scores[own])) if scores.dtype != object else np.array(
            sorted(range(len(own)), key=lambda k: (-scores[own[k]], not self.known[i[k]], self.ids[i[k]], self.rows[i[k]])), dtype=np.int64)
        return own[order[:most]]

    def positives(self, label: int, row: int, vector: np.ndarray, mean: np.ndarray, spread: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the best other rows of a label."""
        def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            if len(low) <= most:
                return np.ones(len(low), dtype=bool)
            return high >= np.partition(low, len(low) - most)[len(low) - most]

        at = self.refine(np.flatnonzero((self.labels == label) & (self.rows != row)), vector, mean, spread, keep)
        scores = self.scores(at, vector)
        own = self.best(at, scores, most)
        return at[own], scores[own]

    def negatives(self, label: int, vector: np.ndarray, mean: np.ndarray, spread: np.ndarray, wanted: list[int], most: int,
                  least_share: int, most_share: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each positive's score, (places, scores) of the best rows of other labels inside its window."""
        def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            stays = np.zeros(len(low), dtype=bool)
            for p in wanted:
                bottom, top = least_share * p / 100, most_share * p / 100
                margin = 1e-9 * (abs(bottom) + abs(top)) + 1e-9
                may = (high >= bottom - margin) & (low <= top + margin)
                inside = low[(low >= bottom + margin) & (high <= top - margin)]       # surely in the window
                if len(inside) >= most:
                    may &= high >= np.partition(inside, len(inside) - most)[len(inside) - most]
                stays |= may
            return stays

        at = self.refine(np.flatnonzero(self.labels != label), vector, mean, spread, keep)
        scores, out = self.scores(at, vector), []
        for p in wanted:
            own = np.flatnonzero((scores * 100 >= least_share * p) & (scores * 100 <= most_share * p))
            own = own[self.best(at[own], scores[own], most)]
            out.append((at[own], scores[own]))
        return out


def _small(x: np.ndarray) -> np.ndarray:
    most = int(np.abs(x).max(initial=0))
    return x.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8")


BLOCK_SCHEMA = ("block long, dim int, n int, ids binary, known binary, labels binary, anchors binary, rows binary, width int, "
                "vectors binary, means binary, spreads binary")


def pack(vectors: DataFrame, anchor: Column, id_col: str, label: Column, vector_col: str) -> DataFrame:
    """Blocks of the rows that take part, with a byte per row that marks anchors."""
    v = F.col(f"`{vector_col}`")
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    own = vectors.where(label.isNotNull() & v.isNotNull() & fine).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), v.alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, seen = TaskContext.get().partitionId(), 0, 0
        held: dict[int, list[tuple]] = {}

        def out(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids, known, labels, anchors, rows, x = (np.concatenate(c) for c in zip(*held.pop(dim)))
            means, spreads = summaries(x.astype(np.float64))
            x = _small(x)
            made += 1
            row = {"block": (part << 24) + made - 1, "dim": dim, "n": len(ids), "ids": ids.tobytes(), "known": known.tobytes(), "labels": labels.tobytes(),
                   "anchors": anchors.tobytes(), "rows": rows.tobytes(), "width": x.dtype.itemsize, "vectors": x.tobytes(),
                   "means": means.astype("<f4").tobytes(), "spreads": spreads.astype("<f4").tobytes()}
            kinds = {int: pa.int64(), bytes: pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array([value], type=pa.int32() if name in ("dim", "n", "width") else kinds[type(value)]) for name, value in row.items()],
                                              names=list(row))

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids, lists = batch.column(0), batch.column(3)
            known = ~np.asarray(ids.is_null())
            number, label_, anchor_ = np.asarray(ids.fill_null(0)), np.asarray(batch.column(1)), np.asarray(batch.column(2)) & known
            rows = (np.int64(part) << 33) + seen + np.arange(n)
            seen += n
            first = np.asarray(lists.offsets).astype(np.int64)
            first -= first[0]
            flat, size = np.asarray(lists.flatten()), np.diff(first)
            for dim in np.unique(size).tolist():
                at = np.flatnonzero(size == dim)
                for some in np.array_split(at, -(-len(at) // ROWS)):
                    x = whole_numbers(flat[(first[some][:, None] + np.arange(dim))])
                    held.setdefault(dim, []).append((number[some], known[some], label_[some], anchor_[some], rows[some], x))
                    if sum(len(h[0]) for h in held[dim]) >= ROWS:
                        yield out(dim)
        for dim in list(held):
            yield out(dim)

    return own.mapInArrow(run, BLOCK_SCHEMA)


def _unpack(row: dict) -> tuple:
    """Arrays of a packed block, in the order of Block's arguments."""
    n, dim = row["n"], row["dim"]
    return (dim, np.frombuffer(row["ids"], dtype="<i8"), np.frombuffer(row["known"], dtype=bool), np.frombuffer(row["labels"], dtype="<i8"), np.frombuffer(row["rows"], dtype="<i8"),
            np.frombuffer(row["vectors"], dtype=f"<i{row['width']}").astype(np.int64).reshape(n, dim),
            np.frombuffer(row["means"], dtype="<f4").reshape(n, -1) if dim else np.zeros((n, 0)),
            np.frombuffer(row["spreads"], dtype="<f4").reshape(n, -1) if dim else np.zeros((n, 0)))


ANCHOR_SCHEMA = "row long, id long, label long, dim int, vector binary, mean binary, spread binary"


def _anchors(blocks: DataFrame) -> DataFrame:
    """A row per anchor."""
    names = [f.split()[0] for f in ANCHOR_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = np.flatnonzero(np.frombuffer(row["anchors"], dtype=bool))
                dim, ids, _, labels, rows, x, means, spreads = _unpack(row)
                parts = [pa.array([a[i].astype(kind).tobytes() for i in at.tolist()], type=pa.binary()) for a, kind in ((x, "<i8"), (means, "<f4"), (spreads, "<f4"))]
                yield pa.RecordBatch.from_arrays([pa.array(rows[at]), pa.array(ids[at]), pa.array(labels[at]), pa.array(np.full(len(at), dim, dtype=np.int32)), *parts], names=names)

    return blocks.mapInArrow(run, ANCHOR_SCHEMA)


def _meet(anchors: DataFrame, blocks: DataFrame, n_anchors: int, numbers: DataFrame, function, schema: str) -> DataFrame:
    """``function(anchor rows, Block)`` for every pair of a block of anchors and a block of rows of one length."""
    parts = max(1, -(-n_anchors // ANCHORS))
    left = (anchors.join(F.broadcast(numbers), "dim")
            .select("*", F.explode("blocks").alias("block"), F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part")).drop("blocks"))
    right = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    names = [f.split()[0] for f in schema.split(", ")]

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        for row in b.to_pylist():                  # one
            block = Block(*_unpack(row))
            for one in a.to_pylist():
                vector, mean, spread = (np.frombuffer(one[c], dtype=k) for c, k in (("vector", "<i8"), ("mean", "<f4"), ("spread", "<f4")))
                out += function(one, block, vector, mean.astype(np.float64), spread.astype(np.float64))
        columns = list(zip(*out)) if out else [[]] * len(names)
        return pa.table([pa.array(c, type=pa.int64()) for c in columns], names=names)

    return left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(run, schema)


def _long(score) -> int:
    return max(-LARGEST, min(LARGEST, int(score)))


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", label: Column | None = None, vector_col: str = "embedding",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    label = F.col("label") if label is None else label
    blocks = pack(vectors, anchor, id_col, label, vector_col).checkpoint()
    anchors = _anchors(blocks).checkpoint()
    n_anchors = anchors.count()
    numbers = blocks.groupBy("dim").agg(F.collect_list("block").alias("blocks"))       # a number per block
    rows = blocks.drop("anchors")

    def find_positives(one, block, vector, mean, spread):
        at, scores = block.positives(one["label"], one["row"], vector, mean, spread, positives)
        return [(one["row"], int(block.rows[i]), int(block.ids[i]) if block.known[i] else None, _long(s)) for i, s in zip(at.tolist(), scores.tolist())]

    found = _meet(anchors, rows, n_anchors, numbers, find_positives, "row long, positive_row long, positive_id long, positive_score long")
    first = Window.partitionBy("row").orderBy(F.desc("positive_score"), F.col("positive_id").asc_nulls_last(), "positive_row")
    best = found.withColumn("k", F.row_number().over(first)).where(F.col("k") <= positives)
    per_anchor = best.groupBy("row").agg(F.collect_list(F.struct("positive_score", "positive_id", "positive_row")).alias("positives"))
    with_positives = anchors.join(per_anchor, "row").checkpoint()

    def find_negatives(one, block, vector, mean, spread):
        wanted = [p["positive_score"] for p in one["positives"]]
        got = block.negatives(one["label"], vector, mean, spread, wanted, negatives, low, high)
        return [(one["row"], one["id"], p["positive_row"], p["positive_id"], p["positive_score"], int(block.rows[i]), int(block.ids[i]) if block.known[i] else None, _long(s))
                for p, (at, scores) in zip(one["positives"], got) for i, s in zip(at.tolist(), scores.tolist())]

    hard = _meet(with_positives, rows, n_anchors, numbers, find_negatives,
                 "row long, anchor_id long, positive_row long, positive_id long, positive_score long, negative_row long, negative_id long, negative_score long")
    ranked = Window.partitionBy("row", "positive_row").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last(), "negative_row")
    return (hard.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
