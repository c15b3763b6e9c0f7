"""Operator 1: SentencePiece merge encoding with a prefix table, and decoding.

A merge tokenizer cuts a string in one way only, and dropping the last token of a right
cut leaves a right cut.  So every prefix has one *last token*; the table stores it per
position.  The candidates at a position are the vocabulary pieces that end there (the
matches of an Aho-Corasick automaton); a candidate fits when it and the last token of the
prefix before it stay apart when merged together (the pair test).  The ids of the whole
string are then read backwards through the table, in time linear in its length.

No piece holds the space mark after another character, and characters that occur in no
piece never merge, so a text may be cut at those places first; the cuts of short chunks are
kept in a bounded cache.  The model file's path is a parameter; executors read the file.

Results for odd input: null or empty text gives only the end id and an empty decoded
text; repeated rows give repeated results; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CACHE_CHUNKS = 250_000     # chunks per generation (two are kept) and Python worker
CACHE_CHUNK_CHARS = 40     # longer chunks are not kept
CACHE_PAIRS = 400_000      # pair tests kept per Python worker


class PrefixTableBPE:
    """Encoder and decoder for one SentencePiece merge model."""

    def __init__(self, model_path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id: dict[int, int] = {}
        self.text: list[str | int] = []          # per id: its text, or its byte value
        self.end_id = sp.eos_id()
        self.unknown_id = sp.unk_id()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.text.append(int(piece[1:-1], 16))
            elif sp.is_control(i):
                self.text.append("")
            elif sp.is_unknown(i):
                self.text.append(" ⁇ ")     # what the library prints for an unknown id
            else:
                self.text.append(piece.replace(SPACE, " "))
                if not sp.is_unused(i):
                    self.score[piece], self.id[piece] = sp.get_score(i), i
        alphabet = {c for p in self.score for c in p}
        if alphabet - self.score.keys() or any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("needs a model whose characters are pieces and whose space mark only leads")
        self.matches = ahocorasick.Automaton()
        for piece in self.score:
            self.matches.add_word(piece, piece)
        self.matches.make_automaton()
        known = "".join(map(re.escape, sorted(alphabet - {SPACE})))
        self.chunks = re.compile(f"{SPACE}*[{known}]+|{SPACE}+|[^{SPACE}{known}]", re.S).findall
        self.pairs: dict[tuple[str, str], bool] = {}
        self.cache: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}

    def merge(self, text: str) -> list[str]:
        """Plain merging: the best-scored neighbour pair first, the leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Do the two pieces stay apart (or the one piece stay whole, when left is empty)?"""
        key = (left, right)
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        fit = self.pairs[key] = self.merge(left + right) == ([left, right] if left else [right])
        return fit

    def cut(self, chunk: str) -> list[str]:
        """The pieces of one chunk, by the prefix table."""
        if len(chunk) == 1:
            return [chunk]
        last: list[str | None] = [None] * (len(chunk) + 1)
        last[0] = ""
        fits, tested = self.fits, self.pairs
        for end, piece in self.matches.iter(chunk):
            if last[end + 1] is None:
                before = last[end + 1 - len(piece)]
                if before is not None:
                    fit = tested.get((before, piece))
                    if fits(before, piece) if fit is None else fit:
                        last[end + 1] = piece
        pieces, at = [], len(chunk)
        while at:
            pieces.append(last[at])
            at -= len(last[at])
        return pieces[::-1]

    def chunk_ids(self, chunk: str) -> list[int]:
        ids: list[int] = []
        for piece in self.cut(chunk):
            i = self.id.get(piece)
            if i is not None:
                ids.append(i)
            elif self.byte_id:
                ids.extend(self.byte_id[b] for b in piece.encode())
            else:
                ids.append(self.unknown_id)
        return ids

    def join_text(self, ids: list[int]) -> str:
        """The pieces' texts in a row; runs of byte ids are read as UTF-8."""
        out, run = [], bytearray()
        for i in ids:
            t = self.text[i]
            if isinstance(t, int):
                run.append(t)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(t)
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.join_text(ids)
        return text[1:] if text.startswith(" ") else text

    def _chunk(self, chunk: str) -> tuple[str, str]:
        made = self.older.get(chunk)
        if made is None:
            ids = self.chunk_ids(chunk)
            made = (" ".join(map(str, ids)), self.join_text(ids))
        if len(chunk) <= CACHE_CHUNK_CHARS:
            if len(self.cache) >= CACHE_CHUNKS:
                self.older, self.cache = self.cache, {}
            self.cache[chunk] = made
        return made

    def encode_text(self, text: str | None) -> tuple[str, str]:
        """(ids as decimals joined by a space, decoded text) of a whole text, end id last."""
        if not text:
            return str(self.end_id), ""
        known, slow = self.cache.get, self._chunk
        made = [known(c) or slow(c) for c in self.chunks((SPACE + text).replace(" ", SPACE))]
        ids = " ".join([m[0] for m in made])
        decoded = "".join([m[1] for m in made])
        return f"{ids} {self.end_id}", decoded[1:] if decoded.startswith(" ") else decoded


_ENCODERS: dict[str, PrefixTableBPE] = {}


def encoder(model_path: str) -> PrefixTableBPE:
    """The worker's encoder of a model file."""
    if model_path not in _ENCODERS:
        _ENCODERS[model_path] = PrefixTableBPE(model_path)
    return _ENCODERS[model_path]


def encode_ids(model_path: str):
    """Column function: text -> (ids array, decoded text)."""
    @F.pandas_udf("struct<ids: array<int>, decoded: string>")
    def run(texts: pd.Series) -> pd.DataFrame:
        enc = encoder(model_path)
        rows = [enc.encode_text(t) for t in texts]
        return pd.DataFrame({"ids": [[int(i) for i in ids.split()] for ids, _ in rows], "decoded": [d for _, d in rows]})
    return run


def encode_digests(model_path: str):
    """Column function: text -> (n_tokens, sha256 of the decimal ids, sha256 of the decoded text)."""
    @F.pandas_udf("struct<n_tokens: long, ids_sha256: string, decoded_sha256: string>")
    def run(texts: pd.Series) -> pd.DataFrame:
        enc = encoder(model_path)
        out = []
        for t in texts:
            ids, decoded = enc.encode_text(t)
            out.append((ids.count(" ") + 1, hashlib.sha256(ids.encode()).hexdigest(),
                        hashlib.sha256(decoded.encode()).hexdigest()))
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, the ids (end id last) and the decoded text."""
    made = docs.select(F.col(id_col), encode_ids(model_path)(F.col(text_col)).alias("_e"))
    return made.select(id_col, F.col("_e.ids").alias("ids"), F.col("_e.decoded").alias("decoded"))


def encode_document_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_tokens and the digests of ids and decoded text (nothing long leaves the task)."""
    made = docs.select(F.col(id_col), encode_digests(model_path)(F.col(text_col)).alias("_e"))
    return made.select(id_col, "_e.n_tokens", "_e.ids_sha256", "_e.decoded_sha256")
