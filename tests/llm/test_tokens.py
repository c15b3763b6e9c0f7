"""Operators 1 and 2."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from panelspark.llm import packing, sentencepiece_bpe

from .conftest import ODD

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_prefix_table_equals_the_library():
    sp, own = sentencepiece.SentencePieceProcessor(model_file=MODEL), sentencepiece_bpe.PrefixTableBPE(MODEL)
    r = random.Random(3)
    texts = [t for _, t in ODD if t] + ["".join(r.choice("abcdeéß ▁\n01.日😀") for _ in range(r.randrange(1, 80))) for _ in range(300)]
    for t in texts:
        want = sp.encode(t) + [2]
        ids, decoded = own.encode_text(t)
        assert [int(i) for i in ids.split()] == want, t[:50]
        assert decoded == own.decode(want) == sp.decode(want), t[:50]


def test_every_prefix_has_one_last_token():
    own = sentencepiece_bpe.PrefixTableBPE(MODEL)
    for word in ("▁internationalisation", "▁unbelievably", "thththhehe"):
        assert own.cut(word) == own.merge(word)


def test_encode_documents(odd, empty):
    rows = sentencepiece_bpe.encode_document_digests(odd, MODEL).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = sorted((str(i), (ids := sp.encode(t or "") + [2]) and len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(sp.decode(ids).encode()).hexdigest()) for i, t in ODD)
    assert sorted((str(r[0]), *r[1:]) for r in rows) == want
    assert sentencepiece_bpe.encode_document_digests(empty, MODEL).count() == 0
    full = {r["doc_id"]: r for r in sentencepiece_bpe.encode_documents(odd, MODEL).collect()}
    assert full[2]["ids"] == [2] and full[2]["decoded"] == "" and full[10]["decoded"] == dict(ODD)[10]


def _pieces_fit(rows, documents, capacity=2048):
    """Every id in one piece, sequences gapless and within capacity; returns the padding."""
    tok = Tokenizer.from_file(BYTES)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    want = defaultdict(list)
    for i, t in documents:
        want[i].append(tok.encode(t or "", add_special_tokens=False).ids + [1])
    assert by_doc.keys() == want.keys()
    for i, copies in want.items():
        ids, n = copies[0], len(copies)
        assert sum(r["length"] for r in by_doc[i]) == n * len(ids)
        cover = np.zeros(len(ids), dtype=int)
        for r in by_doc[i]:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert r["doc_tokens"] == len(ids) and zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r["ids_crc32"]
            cover[r["start"]:r["start"] + r["length"]] += 1
        assert (cover == n).all()
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
        assert {r["padding"] for r in pieces} == {0 if at & (at - 1) == 0 else capacity - at}
    return padding


def test_pack_documents(odd, empty):
    rows = packing.pack_documents(odd, BYTES, with_ids=True).collect()
    assert _pieces_fit(rows, ODD) == 0
    assert all(len(r["ids"]) == r["length"] for r in rows)
    assert packing.pack_documents(empty, BYTES).count() == 0


def test_pack_whole_table(ready):
    from panelspark.llm import queries
    docs = queries.read(ready, "/root/testdata/sf0.001", "documents")
    rows = queries.op2_packing(ready, "/root/testdata/sf0.001").collect()
    assert _pieces_fit(rows, [(r["doc_id"], r["text"]) for r in docs.collect()]) == 0


def test_level_choice_is_the_smallest_sum_of_squares():
    r, packer = random.Random(1), packing.SumOfSquares(64)
    for _ in range(3000):
        size = r.randrange(1, 64)

        def squares(level):
            n = packer.count.copy()
            if level:
                n[level] -= 1
            if level + size < 64:
                n[level + size] += 1
            return int((n[1:64] ** 2).sum())
        open_levels = [0] + [h for h in range(1, 65 - size) if packer.count[h]]
        level = packer.level_for(size)
        assert level in open_levels and squares(level) == min(map(squares, open_levels))
        packer.add(size, (0, 0, size, b"\0" * 4 * size))
    assert sum(len(w) for w in packer.open) == packer.count.sum()


def test_a_row_of_pieces_is_cut_at_powers_of_two():
    pieces = [(1, 0, 50, b"\1" * 200), (2, 0, 27, b"\2" * 108)]
    windows = [sum(len(p[3]) // 4 for p in w) for w in packing._cut_row(pieces, 32)]
    assert windows == [32, 32, 8, 4, 1]
