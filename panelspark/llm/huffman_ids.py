"""Operator 11: token ids in files, by canonical length-limited Huffman codes of the whole corpus.

Writing (``write_ids``):

1. The documents are dealt out by ranges of their id and sorted, so the parts follow each other in
   ascending order (null ids first).  Every task tokenises its rows and cuts the ids, in a row, into *pages* of at
   most ``PAGE_IDS`` ids; a long document goes over several pages.  Pages are a table in the target folder.
2. The ids are counted over all pages: one vector per task, summed by id.  The counts (at most one per id
   of the vocabulary) give the code lengths on the driver, by package-merge with at most ``MAX_BITS`` bits.
3. Every page becomes a *block* that needs no other one: canonical codes in a row of bits, the bit offset of
   every ``CHECKPOINT``-th id, the documents' ids per block, and a check sum.

A folder holds ``codebook`` (the code lengths; canonical codes follow from them) and ``blocks``, both Parquet, so
any store that Spark writes will do.  A block row has its part, its number there, the ids of its documents and the bytes:
a header of little-endian numbers (``HEADER``), ids per document (4 bytes each), checkpoints (4 bytes each), bits.

Reading (``read_ids``): every block is decoded alone.  A table of 2^(longest code) entries gives id and length of the code
that a bit string starts with; all checkpoints of a block are decoded side by side, one id each per step.  Whole documents come out of
one block; the pieces of a document that goes over several are put together by its place.

Results for odd input: null and empty texts have the end id alone; rows of one id, or without one, follow each other in
the order of the table's files; an empty table gives folders without blocks and no rows; other columns are ignored.  A block whose check sum is
wrong raises.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunk_tokens import open_tokenizer, slices, with_end

END_ID = 1
PAGE_IDS = 1 << 16
CHECKPOINT = 128
MAX_BITS = 20
CUT_BYTES = 8 << 20         # bytes of text that are cut into words together
MAGIC = b"HUF1"
# magic, ids before the block, ids of its first document in blocks before, ids, documents, bits, 1 if its last document goes on, crc of the rest
HEADER = struct.Struct("<4sQQIIQBI")


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bits per symbol of an optimal prefix code of at most ``max_bits`` bits (package-merge); 0 for a count of 0.

    The limit is raised where so many symbols cannot have codes that short.
    """
    out = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n < 2:
        out[used] = 1
        return out
    max_bits = max(max_bits, int(n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    coins = counts[order].astype(np.float64)
    row, is_coin = coins, [np.ones(n, dtype=bool)]
    for _ in range(max_bits - 1):                     # packages of two of the row before, merged with the coins
        pairs = row[:len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([coins, pairs])
        at = np.argsort(both, kind="stable")
        row = both[at]
        is_coin.append(at < n)
    bits, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for coin in reversed(is_coin):                    # the cheapest ``take`` of a row open twice its packages in the row before
        k = int(coin[:take].sum())
        bits[:k] += 1
        take = 2 * (take - k)
    out[order] = bits
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in ascending order of (length, symbol)."""
    codes = np.zeros(len(lengths), dtype=np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    size = lengths[order].astype(np.int64)
    if len(order):
        longest = int(size.max())
        places = np.left_shift(1, longest - size)     # of the longest codes' numbers
        codes[order] = (np.cumsum(places) - places) >> (longest - size)
    return codes


class Coder:
    """Encodes and decodes rows of ids by given code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical_codes(lengths).astype(np.uint64)
        self.longest = max(int(lengths.max(initial=0)), 1)
        self.table: tuple[np.ndarray, np.ndarray] | None = None

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray, int]:
        """(bytes, bit offsets of every CHECKPOINT-th id, bits)."""
        size = self.lengths[ids]
        if len(ids) and not size.all():
            raise ValueError("an id without a code")
        end = np.cumsum(size)
        start, bits = end - size, int(end[-1]) if len(ids) else 0
        word, left = start >> 5, 64 - (start & 31) - size        # a code lies in one 32-bit word and the next
        value = self.codes[ids] << left.astype(np.uint64)
        words = np.zeros((bits + 31) // 32 + 1, dtype=np.float64)    # sums of different bits, exact in a double
        n = len(words)
        words += np.bincount(word, weights=(value >> np.uint64(32)).astype(np.float64), minlength=n)
        words += np.bincount(word + 1, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n)[:n]
        return words.astype(np.uint32).astype(">u4").tobytes()[:(bits + 7) // 8], start[::CHECKPOINT].astype("<u4"), bits

    def decode(self, data: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The n ids of a row of bits, all checkpoints side by side."""
        if n == 0:
            return np.zeros(0, dtype="<u4")
        if self.table is None:
            order = np.lexsort((np.arange(len(self.lengths)), self.lengths))
            order = order[self.lengths[order] > 0]
            times = np.left_shift(1, self.longest - self.lengths[order])
            pad = (1 << self.longest) - int(times.sum())             # bit strings that no code starts with
            self.table = (np.concatenate([np.repeat(order, times), np.zeros(pad, dtype=np.int64)]).astype(np.uint32),
                          np.concatenate([np.repeat(self.lengths[order], times), np.ones(pad, dtype=np.int64)]).astype(np.uint8))
        symbol, size = self.table
        words = np.frombuffer(data + bytes(-len(data) % 4 + 8), dtype=">u4").astype(np.uint64)
        double = (words[:-1] << np.uint64(32)) | words[1:]
        at, out = checkpoints.astype(np.int64), np.zeros((CHECKPOINT, len(checkpoints)), dtype="<u4")
        mask, top = np.uint64((1 << self.longest) - 1), 64 - self.longest
        last = len(double) - 1
        for step in range(CHECKPOINT):
            if step == n - CHECKPOINT * (len(checkpoints) - 1):      # the last lane is at its end
                at = at[:-1]
                if not len(at):
                    break
            peek = (double[np.minimum(at >> 5, last)] >> (top - (at & 31)).astype(np.uint64)) & mask
            out[step, :len(at)] = symbol[peek]
            at = at + size[peek]
        return out.T.ravel()[:n]


def make_block(coder: Coder, before: int, back: int, per: np.ndarray, goes_on: bool, ids: np.ndarray) -> bytes:
    """The bytes of a block: ``per`` ids of each document, ``back`` ids of the first one in blocks before."""
    data, checkpoints, bits = coder.encode(ids)
    rest = per.astype("<u4").tobytes() + checkpoints.tobytes() + data
    return HEADER.pack(MAGIC, before, back, len(ids), len(per), bits, goes_on, zlib.crc32(rest)) + rest


def read_block(coder: Coder, block: bytes) -> tuple[int, int, np.ndarray, bool, np.ndarray]:
    """(ids before the block, ids of its first document in blocks before, ids per document, last one goes on, ids)."""
    magic, before, back, n, docs, _, goes_on, crc = HEADER.unpack_from(block)
    rest = memoryview(block)[HEADER.size:]
    if magic != MAGIC or zlib.crc32(rest) != crc:
        raise ValueError("damaged block")
    lanes = -(-n // CHECKPOINT)
    per = np.frombuffer(rest, dtype="<u4", count=docs).astype(np.int64)
    checkpoints = np.frombuffer(rest, dtype="<u4", count=lanes, offset=4 * docs)
    return before, back, per, bool(goes_on), coder.decode(bytes(rest[4 * (docs + lanes):]), checkpoints, n)


def _pages(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Pages of ids in ascending order of the documents' ids: part, page, ids before in the part, ids of the first
    document before, documents, ids of each, whether the last goes on, ids as bytes."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("place"))
    keys = [F.col("id").asc_nulls_first(), F.col("place").asc()]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("id", "text")
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("page", T.LongType()), T.StructField("before", T.LongType()),
                           T.StructField("back", T.LongType()), T.StructField("n", T.LongType()), T.StructField("goes_on", T.BooleanType()),
                           T.StructField("docs", T.ArrayType(own.schema["id"].dataType)), T.StructField("per", T.BinaryType()),
                           T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part = open_tokenizer(tokenizer_path, leading_space=False), TaskContext.get().partitionId()
        wide = "<u2" if max(tok.vocabulary, end_id + 1) <= 1 << 16 else "<u4"
        page = before = 0
        kind = None
        flat, per, own, back = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64), None, 0     # what no page holds yet

        def out(n: int, docs: pa.Array, sizes: np.ndarray, goes_on: bool) -> pa.RecordBatch:
            nonlocal page, before
            row = [part, page, before, back, n, goes_on, docs.to_pylist(), sizes.astype("<u4").tobytes(), flat[:n].astype(wide).tobytes()]
            page, before = page + 1, before + n
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, kind)], schema=kind)

        for batch in batches:
            if kind is None:
                id_type = batch.schema.field(0).type
                own = pa.array([], type=id_type)
                kind = pa.schema([("part", pa.int32()), ("page", pa.int64()), ("before", pa.int64()), ("back", pa.int64()), ("n", pa.int64()),
                                  ("goes_on", pa.bool_()), ("docs", pa.list_(id_type)), ("per", pa.binary()), ("ids", pa.binary())])
            for start, rows in slices(batch.column(1), CUT_BYTES):
                new, sizes = with_end(*tok.ids(batch.column(1).slice(start, rows)), end_id)
                flat, per = np.concatenate([flat, new]), np.concatenate([per, sizes])
                own = pa.concat_arrays([own, batch.column(0).slice(start, rows)])
                while len(flat) >= PAGE_IDS:
                    ends = np.cumsum(per)
                    last = int(np.searchsorted(ends, PAGE_IDS))          # the document that the page ends in
                    inside = PAGE_IDS - int(ends[last - 1] if last else 0)
                    goes_on = inside < per[last]
                    yield out(PAGE_IDS, own.slice(0, last + 1), np.append(per[:last], inside), goes_on)
                    flat = flat[PAGE_IDS:]
                    if goes_on:
                        back = inside + (back if last == 0 else 0)
                        own, per = own.slice(last), np.append(per[last] - inside, per[last + 1:])
                    else:
                        own, per, back = own.slice(last + 1), per[last + 1:], 0
        if len(flat):
            yield out(len(flat), own, per, False)

    return dealt.mapInArrow(run, schema)


def _counts(pages: DataFrame) -> DataFrame:
    """(symbol, n) over all pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids, n in zip(batch.column(0), batch.column(1).to_pylist()):
                got = np.bincount(_raw(ids, n))
                if len(got) > len(total):
                    total, got = got, total
                total[:len(got)] += got
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["symbol", "n"])

    return pages.select("ids", "n").mapInArrow(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))


def _raw(ids: pa.Scalar, n: int) -> np.ndarray:
    data = ids.as_buffer()
    return np.frombuffer(data, dtype=f"<u{len(data) // max(n, 1)}")


def write_ids(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
              max_bits: int = MAX_BITS) -> None:
    """Writes the ids of all documents to ``folder``: ``pages`` (plain ids), ``codebook`` and ``blocks``."""
    spark = docs.sparkSession
    _pages(docs, tokenizer_path, end_id, id_col, text_col).write.option("compression", "zstd").parquet(f"{folder}/pages")
    pages = spark.read.parquet(f"{folder}/pages")
    counts = {r["symbol"]: r["n"] for r in _counts(pages).collect()}          # at most one row per id of the vocabulary
    dense = np.zeros(max(counts, default=-1) + 1, dtype=np.int64)
    dense[list(counts)] = list(counts.values())
    lengths = code_lengths(dense, max_bits)
    spark.createDataFrame([(lengths.tobytes(), CHECKPOINT, end_id)], "lengths binary, checkpoint int, end_id int").coalesce(1).write.parquet(f"{folder}/codebook")

    # ids before each part: one row per part
    parts = pages.groupBy("part").agg(F.sum("n").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("part_before"))
    placed = pages.join(F.broadcast(parts), "part").select(
        "part", "page", (F.col("before") + F.col("part_before")).alias("before"), "back", "n", "goes_on", "docs", "per", "ids")
    schema = T.StructType([pages.schema["part"], pages.schema["page"], pages.schema["docs"], T.StructField("block", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(lengths)
        for batch in batches:
            part, page, before, back, n, goes_on, docs_, per, ids = batch.columns
            for i in range(batch.num_rows):
                block = make_block(coder, before[i].as_py(), back[i].as_py(), np.frombuffer(per[i].as_py(), dtype="<u4"), goes_on[i].as_py(), _raw(ids[i], n[i].as_py()))
                yield pa.RecordBatch.from_arrays([part.slice(i, 1), page.slice(i, 1), docs_.slice(i, 1), pa.array([block], type=pa.binary())],
                                                 names=["part", "page", "docs", "block"])

    placed.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{folder}/blocks")


def _pieces(spark: SparkSession, folder: str, with_ids: bool) -> DataFrame:
    """A row per document and block: id, start of the document, start of the piece, ids, crc32, whether it is whole, and the ids if asked for."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    book = spark.read.parquet(f"{folder}/codebook").first()
    lengths = np.frombuffer(bytes(book["lengths"]), dtype=np.uint8)
    fields = [T.StructField("id", blocks.schema["docs"].dataType.elementType), T.StructField("start", T.LongType()), T.StructField("at", T.LongType()),
              T.StructField("n", T.LongType()), T.StructField("crc", T.LongType()), T.StructField("whole", T.BooleanType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                before, back, per, goes_on, ids = read_block(coder, batch.column(1)[i].as_py())
                docs = batch.column(0)[i].values
                first = np.cumsum(per) - per
                start, whole = before + first, np.ones(len(per), dtype=bool)
                begin = start.copy()
                if len(per):
                    begin[0] -= back
                    whole[0] &= back == 0
                    whole[-1] &= not goes_on
                data, ends = memoryview(ids.tobytes()), (4 * np.append(first, len(ids))).tolist()
                crc = [zlib.crc32(data[a:b]) for a, b in zip(ends, ends[1:])]
                columns = [docs, pa.array(begin), pa.array(start), pa.array(per), pa.array(crc, type=pa.int64()), pa.array(whole)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(first, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return blocks.select("docs", "block").mapInArrow(run, T.StructType(fields))


@F.pandas_udf(T.LongType())
def _joined_crc(pieces: pd.Series) -> pd.Series:
    """crc32 of pieces (at, n, crc of n 4-byte ids) in a row, from theirs."""
    def one(row) -> int:
        crc = 0
        for p in row:
            rest = 4 * p["n"]                 # crc(a + b) = crc(b) with a's crc carried over b's length; it is linear
            moved = shift = 0
            moved = crc
            for k in range(0, rest, 1 << 20):
                zeros = bytes(min(1 << 20, rest - k))
                moved, shift = zlib.crc32(zeros, moved), zlib.crc32(zeros, shift)
            crc = moved ^ shift ^ p["crc"]
        return crc
    return pieces.map(one)


def read_ids(spark: SparkSession, folder: str, id_name: str = "doc_id") -> DataFrame:
    """Per document of a folder: id, start (ids of all documents before it), n_tokens, ids_crc32."""
    pieces = _pieces(spark, folder, with_ids=False).checkpoint()          # decoded once: a few numbers per document
    whole = pieces.where("whole").select(F.col("id").alias(id_name), "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    cut = pieces.where("NOT whole").groupBy("id", "start").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces"))
    return whole.union(cut.select("id", "start", "n", _joined_crc("pieces")))


def read_token_ids(spark: SparkSession, folder: str, id_name: str = "doc_id") -> DataFrame:
    """Per document of a folder: id, start and its ids as an array."""
    pieces = _pieces(spark, folder, with_ids=True)
    return (pieces.groupBy("id", "start").agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("p"))
            .select(F.col("id").alias(id_name), "start", F.flatten(F.col("p.ids")).alias("ids")))


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Writes the documents' ids to the shared checkpoint folder and reads them back."""
    spark = docs.sparkSession
    folder = f"{spark.sparkContext.getCheckpointDir()}/token-ids-{uuid.uuid4()}"
    write_ids(docs, tokenizer_path, folder, end_id)
    return read_ids(spark, folder)
