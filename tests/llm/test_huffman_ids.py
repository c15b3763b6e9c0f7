"""Operator 11: codes, blocks and whole files."""

import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelspark.llm import huffman_ids
from panelspark.llm.chunk_tokens import ChunkTokenizer, slices
from panelspark.llm.huffman_ids import CHECKPOINT, Coder, canonical_codes, code_lengths, make_block, read_block

from .conftest import ODD, prose

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["don't won't! it's 'tis a' b' s' 's t!'s", "a \n b", "x y　z  ", " a", "a ", "İstanbul ΣΑΣ Σ, é ſ é", "12,345.6 a1b2 <|startoftext|>x",
          "tab\tsep\nline\r\nend", "\x1c \x1f a\x85b c", "word,word ,word word,, (word) word's, naïve,", "<|endoftext|> a", "<|EndOfText|> A", "ÀÉ ÀÉ, A\u0300 İI", "a  b", ".,.", "é" * 50 + "."]


def huffman_bits(counts):
    heap = [(int(c), i) for i, c in enumerate(counts) if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], a[1]))
    return total


def limited_bits(counts, limit):
    """Fewest bits of a prefix code of at most ``limit`` bits, by trying every non-decreasing row of lengths."""
    counts = sorted(counts, reverse=True)
    best = [float("inf")]

    def go(i, least, room, cost):
        if cost >= best[0]:
            return
        if i == len(counts):
            best[0] = cost
            return
        for size in range(least, limit + 1):
            left = room - 2 ** (limit - size)
            if left >= len(counts) - i - 1:
                go(i + 1, size, left, cost + size * counts[i])
    go(0, 1, 2 ** limit, 0)
    return best[0]


def test_code_lengths_are_optimal_with_and_without_a_limit():
    rng = np.random.default_rng(4)
    for n in (2, 3, 17, 400):
        counts = rng.zipf(1.4, n).clip(1, 10 ** 9)
        bits = code_lengths(counts, 50)
        assert (bits * counts).sum() == huffman_bits(counts)
    for _ in range(30):
        counts = rng.zipf(1.2, 7).clip(1, 10 ** 6)
        bits = code_lengths(counts, 4)
        assert bits.max() <= 4 and (bits * counts).sum() == limited_bits(counts.tolist(), 4)
    assert code_lengths(np.array([0, 5, 0])).tolist() == [0, 1, 0] and code_lengths(np.zeros(0, dtype=int)).tolist() == []
    assert code_lengths(np.ones(300, dtype=int), 4).max() == 9        # 300 codes of four bits do not exist


def test_codes_are_canonical_and_prefix_free():
    lengths = code_lengths(np.random.default_rng(2).zipf(1.3, 200).clip(1, 10 ** 6), 12)
    text = [format(c, f"0{n}b") for c, n in zip(canonical_codes(lengths).tolist(), lengths.tolist())]
    assert not any(a != b and b.startswith(a) for a in text for b in text)
    order = sorted(range(200), key=lambda i: (lengths[i], i))
    assert [text[i] for i in order] == sorted(text)


@pytest.mark.parametrize("n", [0, 1, 2, CHECKPOINT - 1, CHECKPOINT, CHECKPOINT + 1, 5000])
def test_bits_come_back_from_every_checkpoint(n):
    ids = np.random.default_rng(n).zipf(1.2, n).clip(1, 3000) - 1
    coder = Coder(code_lengths(np.bincount(ids, minlength=2) + 1))
    data, checkpoints, bits = coder.encode(ids)
    assert coder.decode(data, checkpoints, n).tolist() == ids.tolist()
    assert bits == sum(int(coder.lengths[i]) for i in ids) and len(data) == -(-bits // 8)
    text = "".join(format(int(coder.codes[i]), f"0{coder.lengths[i]}b") for i in ids)
    assert text == "".join(format(b, "08b") for b in data)[:bits]
    for k, at in enumerate(checkpoints.tolist()):            # a lane needs nothing before its checkpoint
        lane = ids[k * CHECKPOINT:(k + 1) * CHECKPOINT]
        first = format(int(coder.codes[lane[0]]), f"0{coder.lengths[lane[0]]}b")
        assert text[at:].startswith(first)


def test_a_damaged_block_raises():
    ids = np.arange(50) % 7
    coder = Coder(code_lengths(np.bincount(ids)))
    block = make_block(coder, 10, 3, np.array([20, 30]), True, ids)
    before, back, per, goes_on, got = read_block(coder, block)
    assert (before, back, per.tolist(), goes_on, got.tolist()) == (10, 3, [20, 30], True, ids.tolist())
    with pytest.raises(ValueError, match="damaged"):
        read_block(coder, block[:-1] + bytes([block[-1] ^ 1]))


@pytest.mark.parametrize(("path", "leading_space"), [(WORDS, False), (BYTES, True)])
def test_chunks_equal_the_library(path, leading_space):
    import pyarrow as pa
    r = random.Random(5)
    texts = [t for _, t in ODD] + TRICKY + ["".join(r.choice("abE'é.,!ß \n\t01日😀ʼ") for _ in range(r.randrange(1, 90))) for _ in range(600)]
    tok, own = Tokenizer.from_file(path), ChunkTokenizer(path, leading_space)
    for _ in range(2):                                        # unknown and known chunks
        flat, per = own.ids(pa.array(texts))
        parts = np.split(flat, np.cumsum(per)[:-1])
        for t, got in zip(texts, parts):
            assert got.tolist() == tok.encode(t or "", add_special_tokens=False).ids, t
    assert [n for _, n in slices(pa.array(["abc", None, "d" * 9, "e"]), 4)] == [2, 1, 1]


def brute(documents):
    tok, out, start = Tokenizer.from_file(WORDS), [], 0
    for i, t in documents:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_of_odd_rows(odd, empty, ready, monkeypatch):
    rows = [tuple(r) for r in huffman_ids.round_trip(odd, WORDS).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    want = brute(sorted(ODD, key=lambda d: (d[0] is not None, d[0] or 0)))
    assert sorted(rows, key=lambda r: r[1]) == want
    assert huffman_ids.round_trip(empty, WORDS).count() == 0


def test_documents_over_many_blocks(ready, tmp_path):
    long = prose(9, 120_000)
    docs = [(3, "a b"), (1, long), (2, None), (7, prose(4, 70_000)), (5, ""), (4, long)]
    frame = ready.createDataFrame(docs, "doc_id long, text string")
    folder = str(tmp_path / "ids")
    huffman_ids.write_ids(frame, WORDS, folder)
    rows = [tuple(r) for r in huffman_ids.read_ids(ready, folder).orderBy("start").collect()]
    assert rows == brute(sorted(docs))
    tok = Tokenizer.from_file(WORDS)
    full = {r["doc_id"]: r["ids"] for r in huffman_ids.read_token_ids(ready, folder).collect()}
    assert full == {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in docs}
    blocks = ready.read.parquet(f"{folder}/blocks")
    assert blocks.count() > 5
    plain = 4 * sum(r[2] for r in rows)
    assert blocks.selectExpr("sum(length(block))").first()[0] < plain / 3


def test_whole_table(ready):
    from panelspark.llm import queries
    docs = queries.read(ready, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    rows = [tuple(r) for r in queries.op11_huffman_ids(ready, "/root/testdata/sf0.001").select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()]
    assert rows == brute(sorted(map(tuple, docs)))
