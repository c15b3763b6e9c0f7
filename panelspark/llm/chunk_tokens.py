"""Ids of whole texts by a tokenizers file, a batch of texts at a time.

A batch is cut into chunks in Arrow, its different chunks are numbered there, and only chunks that
the worker has not met go to the tokenizer (many in one call).  The ids of the texts are then
gathered from those of the chunks with array operations, so the cost per word is small and the
tokenizer's own cost goes with the different words.

Where a text may be cut depends on the tokenizer's own split:

* ``leading_space=True`` (byte-level BPE): before a space that stands before a non-space; such a space
  belongs to the word after it.  Texts in which a cut would stand before white space, and texts with a
  special token, go to the tokenizer whole.
* ``leading_space=False`` (white space is dropped): at white space.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

CACHE_CHUNKS = 200_000          # remembered chunks per generation (two are kept) and Python worker
CACHE_CHARS = 40                # longer chunks are not remembered
CHUNKS_AT_ONCE = 2_000          # unknown chunks in one call
TEXT_BYTES = 4 << 20            # bytes of text that are cut together (at least one text)
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"     # no apostrophe: some splits know it
# A word of letters and signs after it are parted there by both kinds of split; each alone is one part.
LETTERS = "^[A-Za-zÀ-ÖØ-öø-ɏ]+$"


def slices(texts: pa.Array, most: int = TEXT_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of texts of about ``most`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, to - at
        at = to


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + lengths[i] - 1 of every i in a row."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) if len(lengths) else np.zeros(0, dtype=np.int64)
    return shift + np.arange(total, dtype=np.int64)


class ChunkTokenizer:
    """Ids of texts; remembers chunks in two generations of bounded size."""

    def __init__(self, path: str, leading_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.leading_space = leading_space
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # what parts many words of one text again: a line end stands alone between two of them,
        # or else the last id of a word is one that ends words
        self.line_end = self.whole(["\n"])[0] if leading_space else b""
        self.ends = np.zeros(self.vocabulary, dtype=bool)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        # where the tokenizer makes letters small itself, fewer words differ once A-Z are
        self.lowers = any(n.get("type") == "Lowercase" for n in self._normalizers(json.loads(self.tokenizer.to_str())["normalizer"]))
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _normalizers(spec: dict | None) -> list[dict]:
        return [] if spec is None else [spec, *spec.get("normalizers", [])]

    def whole(self, texts: list[str]) -> list[bytes]:
        """The tokenizer's own ids of each text."""
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of words that the split leaves whole, by one call."""
        row = np.array(self.tokenizer.encode_batch_fast([("\n" if self.leading_space else " ").join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        if self.leading_space:
            stop = np.flatnonzero(row == np.frombuffer(self.line_end, dtype="<u4")[0]) if len(self.line_end) == 4 else row
            first, last = np.append(0, stop + 1), np.append(stop, len(row))
        else:
            last = np.flatnonzero(self.ends[row]) + 1
            first = np.append(0, last[:-1])
        if len(last) != len(words) or last[-1] != len(row):
            return self.whole(words)
        ids = row.tobytes()
        return [ids[a:b] for a, b in zip((4 * first).tolist(), (4 * last).tolist())]

    def chunks(self, keys: list[str], plain: np.ndarray) -> list[bytes]:
        """Ids of different chunks; plain ones are words that the split leaves whole."""
        newer, older = self.newer, self.older
        found = [newer.get(k) for k in keys]
        if None not in found:
            return found
        if len(newer) >= CACHE_CHUNKS:
            self.older, self.newer = newer, {}
        new = [i for i, ids in enumerate(found) if ids is None]
        for i in new:
            found[i] = older.get(keys[i])
        for good, make in ((True, self._together), (False, self.whole)):
            own = [i for i in new if found[i] is None and plain[i] == good]
            for at in range(0, len(own), CHUNKS_AT_ONCE):
                some = own[at:at + CHUNKS_AT_ONCE]
                for i, ids in zip(some, make([keys[i] for i in some])):
                    found[i] = ids
        self.newer.update((keys[i], found[i]) for i in new if len(keys[i]) <= CACHE_CHARS)
        return found

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids in a row, start, number) of different chunks; signs after letters are looked up by themselves."""
        bare = pc.utf8_ltrim(words, " ") if self.leading_space else words
        stem = pc.utf8_rtrim(bare, SIGNS)
        letters = pc.match_substring_regex(stem, LETTERS)
        lead = np.asarray(pc.subtract(pc.binary_length(words), pc.binary_length(bare))).astype(np.int64)
        to = lead + np.asarray(pc.binary_length(stem))
        whole = np.asarray(pc.binary_length(words)).astype(np.int64)
        parted = letters.to_numpy(zero_copy_only=False) & (to < whole)
        buffers, off = words.buffers(), words.offset
        ends = np.frombuffer(buffers[1], dtype=np.int32)[off:off + len(words) + 1].astype(np.int64)
        cuts = np.stack([ends[:-1] + np.where(parted, to, whole), ends[1:]], axis=1).ravel()
        cuts = np.concatenate([ends[:1], cuts]).astype(np.int32)            # word, its signs, next word, ...
        parts = pa.Array.from_buffers(words.type, len(cuts) - 1, [None, pa.py_buffer(cuts.tobytes()), buffers[2]]).dictionary_encode()
        plain = pc.match_substring_regex(parts.dictionary, LETTERS.replace("^", "^ ?") if self.leading_space else LETTERS).to_numpy(zero_copy_only=False)
        got = self.chunks(parts.dictionary.to_pylist(), plain)
        ids, code = b"".join(got), parts.indices.to_numpy(zero_copy_only=False)
        size = np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // 4
        n = size[code]
        store = np.frombuffer(ids, dtype="<u4")[ragged((np.cumsum(size) - size)[code], n)]
        size = n.reshape(-1, 2).sum(axis=1)
        return store, np.cumsum(size) - size, size

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts in a row, ids per text); a null text counts as empty."""
        texts = pc.fill_null(texts, "")
        n = len(texts)
        given, texts = texts, pc.ascii_lower(texts) if self.lowers else texts
        cut = pc.split_pattern(texts, " ") if self.leading_space else pc.ascii_split_whitespace(texts)
        first = np.asarray(cut.offsets).astype(np.int64)
        first, per_text = first - first[0], np.diff(first)
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        odd = np.zeros(n, dtype=bool)
        for s in self.special:
            odd |= pc.match_substring(texts, s.lower() if self.lowers else s).to_numpy(zero_copy_only=False)
        if self.leading_space:
            blank = pc.or_(pc.equal(words, ""), pc.match_substring_regex(words, r"^[\s\pZ\x1c-\x1f\x{85}]")).to_numpy(zero_copy_only=False)
            if blank.any():
                odd |= np.bincount(np.repeat(np.arange(n), per_text), weights=blank[code], minlength=n) > 0
            heads = first[:-1][per_text > 0]                 # a text's first chunk has no space before it
            firsts, again = np.unique(code[heads], return_inverse=True)
            code[heads] = len(words) + again
            words = pa.concat_arrays([pc.binary_join_element_wise(" ", words, ""), words.take(pa.array(firsts))])
        if odd.any():
            keep = ~np.repeat(odd, per_text)
            code, per_text = code[keep], np.where(odd, 0, per_text)
        store, start, size = self._words(words)
        lengths = size[code]
        flat = store[ragged(start[code], lengths)]
        per = np.bincount(np.repeat(np.arange(n), per_text), weights=lengths, minlength=n).astype(np.int64)
        if odd.any():
            at = np.cumsum(per) - per
            own = self.whole(pc.filter(given, pa.array(odd)).to_pylist())
            rows, pieces, done = np.flatnonzero(odd), [], 0
            for r, ids in zip(rows.tolist(), own):
                pieces += [flat[done:at[r]], np.frombuffer(ids, dtype="<u4")]
                done, per[r] = at[r], len(ids) // 4
            flat = np.concatenate([*pieces, flat[done:]])
        pa.default_memory_pool().release_unused()           # Arrow keeps it otherwise, in every idle worker
        return flat, per


_OPEN: dict[tuple[str, bool], ChunkTokenizer] = {}


def open_tokenizer(path: str, leading_space: bool) -> ChunkTokenizer:
    """The worker's tokenizer of a file."""
    if (path, leading_space) not in _OPEN:
        _OPEN[path, leading_space] = ChunkTokenizer(path, leading_space)
    return _OPEN[path, leading_space]


def with_end(flat: np.ndarray, per: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with an end id after every text."""
    return np.insert(flat, np.cumsum(per), end_id), per + 1
